"""Queries for readers and writers; what is written is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayflow.operators.summaries import route_avg_distance
from delayflow.registry import query
from delayflow.registry.tables import comparable, enriched, features, flights, view
from delayflow.schemas import (
    BATCH_REQUEST_SCHEMA,
    DAY_COLUMN,
    FEATURE_SCHEMA,
    STREAM_REQUEST_SCHEMA,
)
from delayflow.sources import readers as R
from delayflow.sources import writers as W
from delayflow.workspace import new_path

BATCH_FIELDS = [f.name for f in BATCH_REQUEST_SCHEMA.fields]


@query("scan_parquet", "SELECT * FROM flights")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "flights")
    flights(spark, sf_dir).write.parquet(path)
    return R.scan_parquet(spark, path)


@query(
    "scan_json_schema",
    """SELECT Carrier, DayOfMonth, DayOfWeek, DayOfYear, DepDelay, Dest,
    CAST(NULL AS DOUBLE) AS Distance, FlightDate, FlightNum, Origin,
    CAST("Timestamp" AS TIMESTAMP) AS "Timestamp" FROM enriched""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "requests")
    enriched(spark, sf_dir).drop("Distance").write.json(path)
    return comparable(R.scan_json_schema(spark, path, BATCH_REQUEST_SCHEMA))


@query("scan_json_inferred_bz2", "SELECT * FROM features")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "features")
    features(spark, sf_dir).write.json(path, compression="bzip2")
    return comparable(R.scan_json_inferred_bz2(spark, path, FEATURE_SCHEMA))


@query(
    "scan_json_inferred",
    """SELECT Carrier, Origin, Dest, FlightNum, CAST(DayOfYear AS BIGINT) AS DayOfYear, Distance, DepDelay, ArrDelay,
    strftime(FlightDate, '%Y-%m-%d') AS FlightDate FROM features""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "features")
    # The reader goes by the suffix; bzip2, which is slow to write and to read twice, is read by the query above.
    features(spark, sf_dir).write.json(path, compression="gzip")
    # Without a schema: whole numbers are long, dates stay text.
    names = ["Carrier", "Origin", "Dest", "FlightNum", "DayOfYear", "Distance", "DepDelay", "ArrDelay", "FlightDate"]
    return R.scan_json_inferred_bz2(spark, path).select(*names)


def _feature_table(spark: SparkSession, sf_dir: str, database: str) -> str:
    place = new_path(spark, "lakehouse")
    name = f"features_{place[-12:]}"
    rows = features(spark, sf_dir)
    return W.lakehouse_create_or_replace(rows, database, name, location=place)


@query("scan_catalog_table", "SELECT * FROM features")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(R.scan_catalog_table(spark, _feature_table(spark, sf_dir, "flights_db")))


@query("lakehouse_create_or_replace", "SELECT Carrier, count(*) AS flights FROM features GROUP BY Carrier")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _feature_table(spark, sf_dir, "flights_db")
    database, short = name.split(".")
    # Replaced by a summary of itself: read before, under another name after.
    summary = spark.table(name).groupBy("Carrier").agg(F.count("*").alias("flights"))
    replaced = W.lakehouse_create_or_replace(flights(spark, sf_dir), database, f"{short}_summary")
    replaced = W.lakehouse_create_or_replace(summary, database, f"{short}_summary")
    return spark.table(replaced)


@query("write_json_single", "SELECT Origin, Dest, Distance FROM routes")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "distances")
    routes = route_avg_distance(flights(spark, sf_dir))
    W.write_json_single(routes, path, ["Distance", "Origin", "Dest"])
    return spark.read.schema("Origin STRING, Dest STRING, Distance DOUBLE").json(path)


@query(
    "daily_partition_overwrite",
    """SELECT UUID, Carrier, FlightDate AS iso_date,
    CASE WHEN FlightDate = DATE '2024-01-15' THEN 2 ELSE 1 END AS run FROM requests""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "daily")
    rows = view(spark, sf_dir, "requests").select("UUID", "Carrier", F.col("FlightDate").alias("iso_date"))
    W.daily_partition_overwrite(rows.withColumn("run", F.lit(1)), path)
    # The second run of one day replaces that day only.
    again = rows.filter(F.col("iso_date") == F.lit("2024-01-15").cast("date"))
    W.daily_partition_overwrite(again.withColumn("run", F.lit(2)), path, "2024-01-15")
    return spark.read.schema("UUID STRING, Carrier STRING, run INT, iso_date DATE").json(path)


@query("write_json_text", "SELECT * FROM requests")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "text")
    requests = view(spark, sf_dir, "requests")
    W.write_json_text(requests, path)
    return spark.read.schema(requests.schema).json(path)


@query("read_text_parse_json", "SELECT * FROM requests")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "text")
    requests = view(spark, sf_dir, "requests")
    W.write_json_text(requests, path)
    return R.read_text_parse_json(spark, path, requests.schema)


@query(
    "store_scan_with_range",
    """SELECT * FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-15 00:00:00'
    AND TIMESTAMP '2024-01-16 00:00:00'""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/events.parquet"
    return R.store_scan_with_range(spark, path, "ts", "2024-01-15", "2024-01-16")


_DAY = "FlightDate = DATE '2024-01-15'"


@query(
    "append_results",
    f"""SELECT UUID, Prediction, run FROM (SELECT r.UUID, p.Prediction, 1 AS run, FlightDate
      FROM requests r JOIN responses p ON r.UUID = p.UUID)
    UNION ALL SELECT r.UUID, p.Prediction, 2 AS run FROM requests r
      JOIN responses p ON r.UUID = p.UUID WHERE {_DAY}""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "results")
    requests = view(spark, sf_dir, "requests").select("UUID", "FlightDate")
    rows = requests.join(view(spark, sf_dir, "responses"), "UUID")
    day = F.col("FlightDate") == F.lit("2024-01-15").cast("date")
    results = rows.withColumn("run", F.lit(1))
    # All other days are loaded as one day's results, then one day twice by plain inserts.
    W.append_results(results.filter(~day).drop("FlightDate"), path, "2024-01-14")
    W.append_results(results.filter(day).drop("FlightDate"), path, "2024-01-15", idempotent=False)
    again = results.filter(day).drop("FlightDate").withColumn("run", F.lit(2))
    W.append_results(again, path, "2024-01-15", idempotent=False)
    return spark.read.parquet(path).drop(DAY_COLUMN)


@query("load_distance_dim", "SELECT * FROM distances")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    routes = route_avg_distance(flights(spark, sf_dir))
    return W.load_distance_dim(routes, new_path(spark, "distances"))


@query(
    "emit_requests",
    """SELECT UUID, Origin, Dest, Carrier, FlightNum, FlightDate, DepDelay, Distance, DayOfYear,
    DayOfMonth, DayOfWeek, CAST("Timestamp" AS TIMESTAMP) AS "Timestamp" FROM enriched""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "topic")
    W.emit_requests(enriched(spark, sf_dir), "text", {"path": path})
    read = R.read_text_parse_json(spark, path, STREAM_REQUEST_SCHEMA)
    return comparable(read.drop("Prediction", *[c for c in read.columns if c.endswith("_index")]))


@query("insert_prediction_task", "SELECT * FROM enriched")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tasks")
    requests = enriched(spark, sf_dir)
    early = F.col("FlightDate") < F.lit("2024-01-15").cast("date")
    W.insert_prediction_task(requests.filter(early), path)
    W.insert_prediction_task(requests.filter(~early), path)
    return spark.read.parquet(path).drop(DAY_COLUMN)
