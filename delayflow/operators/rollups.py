"""Summaries kept up to date: each day's load adds its own partial counts.

A day's rows are counted by key once, when they come. A summary adds up the partials of all days,
which are as many rows as there are keys in each day, and never reads the facts again. A day
that is loaded again replaces its partial.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayflow.operators.summaries import DOCUMENT_ITEMS, airplanes_per_carrier, pack_documents
from delayflow.sources.writers import daily_partition_overwrite
from delayflow.workspace import materialize

# Keys of the partial tables, by name: what summaries are made of.
MONTHS = ["Year", "Month"]
FLEET = ["Carrier", "TailNum"]
AIRPLANE = ["TailNum", "Carrier", "FlightDate", "FlightNum", "Origin", "Dest"]
PARTIALS = {"months": MONTHS, "fleet": FLEET, "airplanes": AIRPLANE}

ROWS = "_rows"


def merge_day(rows: DataFrame, path: str, day: str, partials: dict[str, Sequence[str]] | None = None) -> None:
    """Count a day's rows by the keys of each partial table under ``path``.

    Counted before the shuffle, so a hot key costs one row per task.
    """
    wanted = partials or PARTIALS
    # Several tables are made of one day: it is read once.
    kept = rows.select(*sorted({c for keys in wanted.values() for c in keys})).persist()
    try:
        for name, keys in wanted.items():
            counted = kept.groupBy(*keys).agg(F.count("*").alias(ROWS))
            daily_partition_overwrite(counted, f"{path}/{name}", day, "parquet")
    finally:
        kept.unpersist()


def rolled_up(spark: SparkSession, path: str, name: str, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows per key over all days loaded so far."""
    return spark.read.parquet(f"{path}/{name}").groupBy(*(keys or PARTIALS[name])).agg(F.sum(ROWS).alias(ROWS))


def months_so_far(spark: SparkSession, path: str) -> DataFrame:
    """``flights_by_month`` of all days loaded so far."""
    totals = rolled_up(spark, path, "months").withColumnRenamed(ROWS, "total_flights")
    return totals.orderBy("Year", "Month")


def fleets_so_far(spark: SparkSession, path: str, max_items: int = DOCUMENT_ITEMS) -> DataFrame:
    """``airplanes_per_carrier`` of all days loaded so far."""
    return airplanes_per_carrier(rolled_up(spark, path, "fleet"), max_items)


def airplanes_so_far(spark: SparkSession, path: str, max_items: int = DOCUMENT_ITEMS) -> DataFrame:
    """``flights_per_airplane`` of all days loaded so far."""
    flights = materialize(rolled_up(spark, path, "airplanes").withColumnRenamed(ROWS, "Copies"), "flights")
    return pack_documents(flights, "TailNum", [*AIRPLANE[1:], "Copies"], "Flights", max_items)
