"""Session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC keeps dates and ISO timestamps unambiguous. Adaptive execution sizes the
# shuffles, turns small sides into broadcasts by their measured size and splits
# skewed join partitions. Stream state lives on disk, so it may outgrow the heap.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

# Counting the rows of a state would look each key up before it is written, and without change logs every
# batch copies whole files of state to its checkpoint.
_STATE = "spark.sql.streaming.stateStore"
STATE_SETTINGS = {
    # Sessions that were not built here keep state in the heap unless they are told.
    f"{_STATE}.providerClass": SETTINGS[f"{_STATE}.providerClass"],
    f"{_STATE}.rocksdb.trackTotalNumberOfRows": "false",
    f"{_STATE}.rocksdb.changelogCheckpointing.enabled": "true",
}


def state_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session for stateful streams, on the same context.

    State is kept in as many partitions as shuffles have, a number that stays with the
    checkpoint and that adaptive execution cannot change. It follows the cluster's
    parallelism here, unless it is given.
    """
    session = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        session.conf.set(key, spark.conf.get(key))
    for key, value in STATE_SETTINGS.items():
        session.conf.set(key, value)
    width = partitions or spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.shuffle.partitions", str(width))
    return session


def build_session(app_name: str = "delayflow", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
