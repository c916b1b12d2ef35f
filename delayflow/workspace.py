"""Intermediate tables in the folder the cluster shares between executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Only a local session, as used in tests, may leave it unset; it then gets one
    temporary folder. On a cluster a machine-local folder would be lost with its
    machine, so a missing setting is an error there.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="delayflow-")
    return _local_roots[context.applicationId]


def session_folder(spark: SparkSession) -> str:
    """Where this application keeps its intermediate tables."""
    return f"{shared_root(spark)}/delayflow/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table that no other call returns."""
    return f"{session_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; frames that read them end with it."""
    discard(spark, session_folder(spark))


def discard(spark: SparkSession, path: str) -> None:
    """Delete one intermediate table."""
    place, files = _at(spark, path)
    files.delete(place, True)


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage, gives the planner true file sizes, and makes values that
    depend on row order (positions, random ids) final even if executors are lost. A caller
    that gives the ``path`` can ``discard`` the table once its readers have run.
    """
    spark = df.sparkSession
    path = path or new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _at(spark: SparkSession, path: str):
    """A path and the file system it is on."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _at(spark, path)
    return files.exists(place)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, in order; none if it is absent."""
    place, files = _at(spark, path)
    if not files.exists(place):
        return []
    return sorted(f.getPath().getName() for f in files.listStatus(place) if f.isDirectory())


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files of a stored table."""
    place, files = _at(spark, path)
    return files.getContentSummary(place).getLength()


def width_for(spark: SparkSession, rows: int, most: int) -> int:
    """Partitions that hold about ``most`` of so many rows each, no fewer than there are cores."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // most))


def measured_bytes(stored: DataFrame, path: str) -> int:
    """Size of a stored table: that of its files, or of its rows at their usual width if that is more.

    Files are compressed, equal values most of all; the rows are counted from their footers.
    """
    width = stored._jdf.schema().defaultSize()
    return max(stored_bytes(stored.sparkSession, path), stored.count() * width)
