"""Stream sinks.

Every query has its own checkpoint, so a restart goes on where the last run ended.
Batch writers put each micro-batch into a folder named after the query and the
batch; a batch that is run again after a failure replaces its folder.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from delayflow.functions.text import to_json_record

BatchWriter = Callable[[DataFrame, int], None]

# Fixed value: length of a micro-batch.
MICROBATCH_INTERVAL = "10 seconds"

# Work off what is there, then stop.
DRAIN = {"availableNow": True}

log = logging.getLogger(__name__)


def start(writer, checkpoint: str, trigger: Mapping | None) -> StreamingQuery:
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def batch_writer_id(batch: DataFrame) -> str:
    """The id of the query that runs a micro-batch.

    It is kept in the checkpoint: a restart has the same, a new query another.
    """
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def _batch_folder(batch: DataFrame, batch_id: int, path: str) -> str:
    return f"{path}/writer={batch_writer_id(batch)}/batch_id={batch_id}"


def stream_append_mode(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "json", trigger: Mapping | None = None
) -> StreamingQuery:
    """Append each row once to files at ``path``."""
    return start(df.writeStream.format(fmt).option("path", path), checkpoint, trigger)


def stream_checkpoint_resume(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "json"
) -> StreamingQuery:
    """Drain what has come since the last run with this checkpoint."""
    return stream_append_mode(df, path, checkpoint, fmt, DRAIN)


def stream_microbatch_10s(
    df: DataFrame, writer: BatchWriter, checkpoint: str, interval: str = MICROBATCH_INTERVAL
) -> StreamingQuery:
    """Hand a batch to ``writer`` every ten seconds."""
    return start(df.writeStream.foreachBatch(writer), checkpoint, {"processingTime": interval})


def stream_sink_response(
    df: DataFrame,
    fmt: str,
    options: Mapping[str, str],
    checkpoint: str,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Rows as JSON ``value`` to a response topic (``kafka``) or folder (``text``)."""
    writer = to_json_record(df).writeStream.format(fmt).options(**options)
    return start(writer, checkpoint, trigger)


def stream_sink_debug(
    df: DataFrame,
    checkpoint: str,
    fmt: str = "console",
    trigger: Mapping | None = None,
    options: Mapping[str, str | int] | None = None,
) -> StreamingQuery:
    """Show the head of each micro-batch.

    ``noop`` only runs and counts it; a format of files, with a ``path`` among its
    ``options``, shows every row.
    """
    return start(df.writeStream.format(fmt).options(**(options or {})), checkpoint, trigger)


def response_writer(path: str) -> BatchWriter:
    """JSON lines per micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        target = _batch_folder(batch, batch_id, path)
        to_json_record(batch).write.mode("overwrite").text(target)

    return write


def topic_writer(fmt: str, options: Mapping[str, str]) -> BatchWriter:
    """JSON values to a topic; a batch run again is sent again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        to_json_record(batch).write.format(fmt).options(**options).mode("append").save()

    return write


def debug_writer(rows: int = 20) -> BatchWriter:
    """The first rows of each micro-batch to the log."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if log.isEnabledFor(logging.DEBUG):
            for row in batch.limit(rows).collect():
                log.debug("batch %s: %s", batch_id, row)

    return write


def latest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The row of greatest order per key, ties broken by all columns."""
    rest = [c for c in df.columns if c != key and c not in order]
    newest = df.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("newest"))
    return newest.select(*[F.col(key) if c == key else F.col(f"newest.{c}") for c in df.columns])


def stored_prediction(df: DataFrame) -> DataFrame:
    """Columns of the prediction store: whole-number class and processing time."""
    return df.select(
        F.col("UUID").alias("uuid"),
        F.col("Origin").alias("origin"),
        F.col("Dest").alias("dest"),
        F.col("Prediction").cast("int").alias("prediction"),
        F.current_timestamp().alias("timestamp"),
    )


def stream_skip_empty_batch(
    df: DataFrame, writer: BatchWriter, checkpoint: str, trigger: Mapping | None = None
) -> StreamingQuery:
    """Write a micro-batch only if it has rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # the look at the batch and the write compute it once
        try:
            if not batch.isEmpty():
                writer(batch, batch_id)
        finally:
            batch.unpersist()

    return start(df.writeStream.foreachBatch(write), checkpoint, trigger)


def stream_fanout(
    df: DataFrame,
    writers: Sequence[BatchWriter],
    checkpoint: str,
    trigger: Mapping | None = None,
    rejects: BatchWriter | None = None,
    required: Sequence[str] = (),
) -> StreamingQuery:
    """One query that computes each micro-batch once and hands it to all writers.

    With ``rejects``, rows that lack a ``required`` value go there and nowhere else.
    """
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required], F.lit(True))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            accepted = batch.filter(complete) if rejects else batch
            for writer in writers:
                writer(accepted, batch_id)
            if rejects:
                rejects(batch.filter(~complete), batch_id)
        finally:
            batch.unpersist()

    return start(df.writeStream.foreachBatch(write), checkpoint, trigger)


def stream_route(
    df: DataFrame,
    writers: Sequence[BatchWriter],
    dead: BatchWriter,
    checkpoint: str,
    trigger: Mapping | None = None,
    column: str = "dead",
) -> StreamingQuery:
    """Good rows to all writers, dead letters with their raw text to another.

    Every message comes to one of the two, so the rows of both add up to the input.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            good = batch.filter(F.col(column).isNull()).drop(column)
            for writer in writers:
                writer(good, batch_id)
            dead(batch.filter(F.col(column).isNotNull()).select(f"{column}.*"), batch_id)
        finally:
            batch.unpersist()

    return start(df.writeStream.foreachBatch(write), checkpoint, trigger)


def table_writer(path: str, file_format: str = "parquet") -> BatchWriter:
    """Rows per micro-batch as they are; a batch run again replaces its folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(file_format).save(_batch_folder(batch, batch_id, path))

    return write
