"""Casts, defaults and generated values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayflow.schemas import FLIGHTS_PER_PAGE


def int_casts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns to int, truncating toward zero; text that is no number becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast("double").try_cast("int") for c in columns})


def default_if_missing(value: Column, default: float | int | str) -> Column:
    return F.coalesce(value, F.lit(default))


def request_id() -> Column:
    """Random UUID per row. Store the rows before the id is used twice."""
    return F.uuid()


def request_defaults(df: DataFrame, size: int = FLIGHTS_PER_PAGE) -> DataFrame:
    """Paging arguments as ints: missing ``start`` is 0, missing ``end`` the page size."""
    return df.withColumns(
        {
            "start": F.coalesce(F.col("start").try_cast("int"), F.lit(0)),
            "end": F.coalesce(F.col("end").try_cast("int"), F.lit(size)),
        }
    )
