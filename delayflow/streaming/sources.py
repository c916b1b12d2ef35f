"""Stream sources. The connector is a parameter; all give a ``value`` column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Fixed value: a topic is read from its beginning on the first start.
FIRST_OFFSETS = "earliest"

# What one micro-batch of a job takes from a backlog at most, by connector.
RATE_LIMITS = {
    "kafka": {"maxOffsetsPerTrigger": 5_000_000},
    "text": {"maxFilesPerTrigger": 1_000},
}


def stream_source_requests(
    spark: SparkSession, fmt: str, options: Mapping[str, str | int]
) -> DataFrame:
    """Subscribe to requests: a topic with ``kafka``, or a folder with ``text``."""
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("startingOffsets", FIRST_OFFSETS)
    return reader.options(**options).load()


def with_rate_limit(fmt: str, options: Mapping[str, str | int]) -> dict[str, str | int]:
    """Options with the connector's limit per micro-batch; those given come first.

    A limit leaves nothing out: what is over it is taken by the next batches.
    """
    return {**RATE_LIMITS.get(fmt, {}), **options}


def stream_earliest(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Requests in a folder, all files already there included."""
    options: dict[str, str | int] = {"path": path}
    if max_files_per_trigger:
        options["maxFilesPerTrigger"] = max_files_per_trigger
    return stream_source_requests(spark, "text", options)
