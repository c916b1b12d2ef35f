"""Projections, filters and feature extraction; all of them map-only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayflow.functions.times import (
    compose_timestamp,
    day_of_year,
    month_day_string,
    overnight_rollover,
)
from delayflow.schemas import INDEX_FEATURES, REQUEST_FORM_TYPES

# Fixed value: columns a fitted model adds that are of no use to a reader.
MODEL_COLUMNS = [
    *INDEX_FEATURES, "Features_vec", "indices", "values", "rawPrediction", "probability",
]

SCALE = 1_000_000


def project_features(df: DataFrame) -> DataFrame:
    """The thirteen columns features are made of, with DayOfYear as ``month-day`` text."""
    return df.select(
        "FlightNum",
        "FlightDate",
        "DayOfWeek",
        F.col("DayofMonth").alias("DayOfMonth"),
        month_day_string(F.col("Month"), F.col("DayofMonth")).alias("DayOfYear"),
        "Carrier",
        "Origin",
        "Dest",
        "Distance",
        "DepDelay",
        "ArrDelay",
        "CRSDepTime",
        "CRSArrTime",
    )


def filter_not_null_delays(df: DataFrame) -> DataFrame:
    return df.filter(F.col("ArrDelay").isNotNull() & F.col("DepDelay").isNotNull())


def sample_bernoulli(
    df: DataFrame, fraction: float = 0.1, seed: int = 27, key: Sequence[str] | None = None
) -> DataFrame:
    """Each row kept with probability ``fraction``.

    With ``key`` the choice depends only on the key's hash, so it is the same
    however the rows are partitioned.
    """
    if key is None:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    bucket = F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(SCALE))
    return df.filter(bucket < round(fraction * SCALE))


def extract_features(df: DataFrame) -> DataFrame:
    """Feature rows with real instants and date parts."""
    date = F.col("FlightDate").cast("date")
    # The instants come first, so that the rollover does not compute them again.
    timed = df.withColumns(
        {
            "FlightDate": date,
            "CRSDepTime": compose_timestamp(date, F.col("CRSDepTime")),
            "CRSArrTime": compose_timestamp(date, F.col("CRSArrTime")),
        }
    )
    return timed.select(
        "FlightNum",
        "FlightDate",
        F.col("DayOfWeek").cast("int").alias("DayOfWeek"),
        F.col("DayOfMonth").cast("int").alias("DayOfMonth"),
        day_of_year(F.col("FlightDate")).alias("DayOfYear"),
        "Carrier",
        "Origin",
        "Dest",
        "Distance",
        "DepDelay",
        "ArrDelay",
        "CRSDepTime",
        overnight_rollover(F.col("CRSDepTime"), F.col("CRSArrTime")).alias("CRSArrTime"),
    )


def derive_route(df: DataFrame) -> DataFrame:
    """Add ``Route``; NULL where an end is NULL."""
    return df.withColumn("Route", F.concat("Origin", F.lit("-"), "Dest"))


def drop_rename_columns(df: DataFrame) -> DataFrame:
    """Drop what a model added but its prediction, which is named ``Prediction``."""
    return df.drop(*MODEL_COLUMNS).withColumnRenamed("prediction", "Prediction")


def flatten_struct(df: DataFrame, struct: str, fields: Sequence[str]) -> DataFrame:
    """The named fields of a struct as top-level columns."""
    return df.select(*[F.col(f"{struct}.{field}").alias(field) for field in fields])


def coerce_request_fields(df: DataFrame, types: Mapping[str, str] = REQUEST_FORM_TYPES) -> DataFrame:
    """Form fields parsed to their types; unparsable or absent ones become NULL."""
    present = set(df.columns)
    return df.withColumns(
        {
            name: F.col(name).try_cast(kind) if name in present else F.lit(None).cast(kind)
            for name, kind in types.items()
        }
    )
