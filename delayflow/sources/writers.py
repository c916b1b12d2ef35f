"""Batch sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayflow.functions.text import to_json_record
from delayflow.operators.joins import key_distances
from delayflow.operators.ordering import sort_stored
from delayflow.schemas import DAY_COLUMN
from delayflow.workspace import discard, materialize, new_path


def lakehouse_create_or_replace(
    df: DataFrame,
    database: str,
    table: str,
    location: str | None = None,
    using: str | None = None,
) -> str:
    """Create the namespace if absent, create or replace the table, return its name.

    ``using`` names the format of a versioned catalog (say ``iceberg``), which swaps
    the table atomically and keeps its files as Parquet. Without it the table is a
    Parquet table of the session catalog; a new database is put at ``location``.
    """
    spark = df.sparkSession
    name = f"{database}.{table}"
    if using:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {database}")
        writer = df.writeTo(name).using(using)
        writer.tableProperty("write.format.default", "parquet").createOrReplace()
        return name
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    df.write.format("parquet").mode("overwrite").saveAsTable(name)
    return name


def write_json_single(
    df: DataFrame,
    path: str,
    order: Sequence[Column | str],
    one_file: bool = False,
    compression: str | None = None,
) -> None:
    """Replace ``path`` by ordered JSON lines.

    The lines are in as many files as the sort has partitions, whose names follow the order,
    so that reading them by name gives one sequence, whatever the size. A caller who needs
    exactly one file asks for ``one_file`` and has one task sort and write it all. The copy
    that the sort takes its samples from is deleted after the write.
    """
    place = new_path(df.sparkSession, "unsorted")
    stored = materialize(df, "unsorted", place)
    if one_file:
        ordered = stored.coalesce(1).sortWithinPartitions(*order)
    else:
        ordered = sort_stored(stored, order)
    ordered.write.mode("overwrite").json(path, compression=compression)
    discard(df.sparkSession, place)


def daily_partition_overwrite(
    df: DataFrame, path: str, day: str | None = None, file_format: str = "json"
) -> None:
    """Write rows under one directory per ISO date, replacing only the days written.

    With ``day`` the frame is that day's whole output: it replaces the directory even
    if it is empty. Without it the frame carries ``iso_date`` and replaces each day it
    has rows for; rows are gathered by day before the write, to keep each day's files few, and
    a day too large for one task is split.
    """
    if day is not None:
        target = f"{path}/{DAY_COLUMN}={day}"
        df.drop(DAY_COLUMN).write.format(file_format).mode("overwrite").save(target)
        return
    (
        df.hint("rebalance", DAY_COLUMN)
        .write.format(file_format)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY_COLUMN)
        .save(path)
    )


def write_clustered(
    df: DataFrame,
    path: str,
    order: Sequence[str],
    looked_up: Sequence[str],
    distinct: int = 100_000,
    row_group_bytes: int = 16 * 1024 * 1024,
) -> None:
    """Replace ``path`` by Parquet files laid out for point lookups.

    Files are ranges of ``order``, so that the least and greatest values of a row group tell
    most of them off. For the columns ``looked_up`` each row group has a Bloom filter, made for some
    ``distinct`` values, that tells off others. Smaller row groups are skipped more finely.
    """
    spark = df.sparkSession
    place = new_path(spark, "unsorted")
    ordered = sort_stored(materialize(df, "unsorted", place), list(order))
    # A writer's own options lose the case of column names, so these are set for the session.
    settings = {f"parquet.bloom.filter.enabled#{c}": "true" for c in looked_up}
    settings |= {f"parquet.bloom.filter.expected.ndv#{c}": str(distinct) for c in looked_up}
    settings["parquet.block.size"] = str(row_group_bytes)
    # The older form of timestamps, which is the default, has no least and greatest values.
    settings["spark.sql.parquet.outputTimestampType"] = "TIMESTAMP_MICROS"
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        ordered.write.mode("overwrite").parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    discard(spark, place)


def write_json_text(df: DataFrame, path: str) -> None:
    """Replace ``path`` by one JSON text line per record."""
    to_json_record(df).write.mode("overwrite").text(path)


def append_results(df: DataFrame, path: str, day: str, idempotent: bool = True) -> None:
    """Add a day's results to the collection at ``path``.

    By default a rerun replaces the day. ``idempotent=False`` is a plain insert, after
    which a rerun leaves every row twice.
    """
    if idempotent:
        daily_partition_overwrite(df, path, day, file_format="parquet")
    else:
        df.drop(DAY_COLUMN).write.mode("append").parquet(f"{path}/{DAY_COLUMN}={day}")


def load_distance_dim(routes: DataFrame, path: str) -> DataFrame:
    """Replace the distance table at ``path``: one whole-number distance per pair."""
    key_distances(routes).write.mode("overwrite").parquet(path)
    return routes.sparkSession.read.parquet(path)


def emit_requests(df: DataFrame, fmt: str, options: Mapping[str, str]) -> None:
    """Publish each record as a JSON ``value``, to a topic or to text files."""
    to_json_record(df).write.format(fmt).options(**options).mode("append").save()


def insert_prediction_task(df: DataFrame, path: str) -> None:
    """Append enriched requests to the task collection, one directory per request day."""
    dated = df.withColumn(DAY_COLUMN, F.col("Timestamp").try_cast("date"))
    gathered = dated.hint("rebalance", DAY_COLUMN)
    gathered.write.mode("append").partitionBy(DAY_COLUMN).parquet(path)
