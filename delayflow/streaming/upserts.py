"""A table that micro-batches are merged into by key.

Rows lie in hash buckets of their key. A batch writes the buckets it touches anew, all of them in
one job under a folder of its own, which counts once the job's success mark is there. A bucket is
read from the last batch that wrote it, so a read is a plain scan of one copy of each bucket,
and a lookup by key one of a single bucket. What no reader needs any more is deleted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from delayflow.streaming.sinks import BatchWriter, batch_writer_id, latest_per_key, start, stored_prediction
from delayflow.workspace import discard, exists, folders

# A bucket should fill a file of some hundred megabytes; their number stays with the table.
BUCKETS = 64
BUCKET = "key_bucket"
UNKEYED = "-unkeyed"


@dataclass(frozen=True, order=True)
class Commit:
    """The folder of one batch: its place in the order of batches, its query and batch number."""

    number: int
    writer: str
    batch: int

    @property
    def name(self) -> str:
        return f"commit={self.number:012d}_{self.batch}_{self.writer}"

    @classmethod
    def of(cls, name: str) -> Commit:
        number, batch, writer = name.removeprefix("commit=").split("_", 2)
        return cls(int(number), writer, int(batch))


class Target:
    """The files of an upsert table; all of it is told by names of folders."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def layout(self) -> int | None:
        """Number of buckets, None before the first batch."""
        kept = [int(n.split("=")[1]) for n in folders(self.spark, self.path) if n.startswith("buckets=")]
        return kept[0] if kept else None

    def root(self, buckets: int) -> str:
        return f"{self.path}/buckets={buckets}"

    def commits(self) -> list[Commit]:
        """Batches whose write ended, in order."""
        buckets = self.layout()
        if buckets is None:
            return []
        root = self.root(buckets)
        found = [Commit.of(n) for n in folders(self.spark, root) if n.startswith("commit=")]
        return sorted(c for c in found if exists(self.spark, f"{root}/{c.name}/_SUCCESS"))

    def versions(self, commits: Sequence[Commit]) -> dict[int, list[Commit]]:
        """Batches that hold each bucket, in order; as many buckets as the table has at most."""
        found: dict[int, list[Commit]] = {}
        root = self.root(self.layout() or 0)
        for commit in commits:
            for name in folders(self.spark, f"{root}/{commit.name}"):
                found.setdefault(int(name.split("=")[1]), []).append(commit)
        return found

    def read(self, versions: dict[int, list[Commit]], wanted: Sequence[int] | None = None) -> DataFrame | None:
        """The last copy of the buckets, without the column of their number."""
        root = self.root(self.layout() or 0)
        paths = [
            f"{root}/{held[-1].name}/{BUCKET}={bucket}"
            for bucket, held in sorted(versions.items())
            if wanted is None or bucket in wanted
        ]
        return self.spark.read.parquet(*paths) if paths else None

    def clean(self, versions: dict[int, list[Commit]], commits: Sequence[Commit]) -> None:
        """Delete copies older than the last two, and empty batches that are not the last of a query.

        A reader that began before the last batch still finds its files.
        """
        root = self.root(self.layout() or 0)
        for bucket, held in versions.items():
            for commit in held[:-2]:
                discard(self.spark, f"{root}/{commit.name}/{BUCKET}={bucket}")
        needed = {commit for held in versions.values() for commit in held[-2:]}
        needed |= {max(c for c in commits if c.writer == writer) for writer in {c.writer for c in commits}}
        for commit in commits:
            if commit not in needed:
                discard(self.spark, f"{root}/{commit.name}")


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def upsert(batch: DataFrame, path: str, key: str, order: Sequence[str], writer: str, batch_id: int, buckets: int = BUCKETS) -> list[int]:
    """Merge a batch into the table at ``path``; gives the buckets that were written.

    Per key the row of greatest ``order`` stays, of equal ones the later batch's. A batch that
    was merged before (same ``writer`` and ``batch_id``) is passed over; one whose write did not end is written
    again. Rows without a key cannot be told apart: they are added beside the table. One
    writer at a time merges into a table.
    """
    spark = batch.sparkSession
    target = Target(spark, path)
    kept = target.layout()
    if kept not in (None, buckets):
        raise ValueError(f"the table has {kept} buckets, not {buckets}")
    commits = target.commits()
    if any(c.writer == writer and c.batch == batch_id for c in commits):
        return []
    batch = batch.persist()
    try:
        # Written first: the batch is not passed over before these rows are there too.
        beside = f"{target.path}{UNKEYED}/writer={writer}/batch_id={batch_id}"
        batch.filter(F.col(key).isNull()).write.mode("overwrite").parquet(beside)
        changes = latest_per_key(batch.filter(F.col(key).isNotNull()), key, order)
        place = bucket_of(F.col(key), buckets)
        # At most as many numbers as the table has buckets.
        touched = sorted(r[0] for r in batch.filter(F.col(key).isNotNull()).select(place).distinct().collect())
        if not touched:
            return []
        versions = target.versions(commits)
        current = target.read(versions, touched)
        merged = changes.withColumn("_batch", F.lit(1))
        if current is not None:
            # Buckets are small next to the table, and every key is one row of either side.
            both = merged.unionByName(current.withColumn("_batch", F.lit(0)), allowMissingColumns=True)
            merged = latest_per_key(both, key, [*order, "_batch"])
        commit = Commit(max((c.number for c in commits), default=0) + 1, writer, batch_id)
        spread = merged.drop("_batch").withColumn(BUCKET, place).repartition(len(touched), BUCKET)
        folder = f"{target.root(buckets)}/{commit.name}"
        spread.write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        if not exists(spark, f"{folder}/_SUCCESS"):
            raise ValueError("the table needs the success marks of Spark's writer")
        for bucket in touched:
            versions.setdefault(bucket, []).append(commit)
        target.clean(versions, [*commits, commit])
        return touched
    finally:
        batch.unpersist()


def upsert_writer(path: str, key: str, order: Sequence[str], buckets: int = BUCKETS) -> BatchWriter:
    """Micro-batches into an upsert table; a batch that is run again changes nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, path, key, order, batch_writer_id(batch), batch_id, buckets)

    return write


def read_upserts(spark: SparkSession, path: str) -> DataFrame:
    """The table as it is after the last batch: one row per key, no history."""
    target = Target(spark, path)
    found = target.read(target.versions(target.commits()))
    if found is None:
        raise FileNotFoundError(f"no batch has been written to {path}")
    return found


def lookup_upsert(spark: SparkSession, path: str, key: str, value: str) -> DataFrame | None:
    """The row of one key, from its bucket alone; None if the bucket was never written."""
    target = Target(spark, path)
    buckets = target.layout()
    if buckets is None:
        return None
    bucket = spark.range(1).select(bucket_of(F.lit(value), buckets)).first()[0]
    found = target.read(target.versions(target.commits()), [bucket])
    return None if found is None else found.filter(F.col(key) == value)


def stream_upsert_latest(
    df: DataFrame,
    path: str,
    key: str,
    order: Sequence[str],
    checkpoint: str,
    trigger: Mapping | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Last write per key wins, by ``order`` and then by batch; read it with ``read_upserts``."""
    return start(df.writeStream.foreachBatch(upsert_writer(path, key, order, buckets)), checkpoint, trigger)


def stream_sink_keyed_upsert(
    df: DataFrame, path: str, checkpoint: str, trigger: Mapping | None = None, buckets: int = BUCKETS
) -> StreamingQuery:
    """Predictions to the table keyed by uuid."""
    return stream_upsert_latest(stored_prediction(df), path, "uuid", ["timestamp"], checkpoint, trigger, buckets)
