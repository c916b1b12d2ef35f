"""Queries for whole jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayflow.plans import jobs as B
from delayflow.registry import query
from delayflow.registry.learning import majority, trained
from delayflow.registry.streams import finish, request_lines
from delayflow.registry.tables import comparable, distances, enriched, features, flights, view
from delayflow.schemas import FEATURE_SCHEMA
from delayflow.sources.readers import scan_json_schema
from delayflow.sources.writers import insert_prediction_task, lakehouse_create_or_replace
from delayflow.streaming import sinks as K
from delayflow.streaming import transforms as X
from delayflow.streaming import upserts as U
from delayflow.workspace import materialize, new_path

DAY = "2024-01-15"
_IN_DAY = f"\"Timestamp\" >= '{DAY}' AND \"Timestamp\" <= '2024-01-16'"


@query("repartition_cache", "SELECT * FROM flights")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    cached = B.repartition_cache(flights(spark, sf_dir))
    try:
        return materialize(cached, "cached")
    finally:
        cached.unpersist()


@query("job_extract", "SELECT * FROM features")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = new_path(spark, "job")
    flights(spark, sf_dir).write.parquet(f"{base}/{B.FACTS}")
    # All rows, not the training sample, so that SQL can follow.
    written = B.job_extract(spark, base, fraction=None)
    return comparable(scan_json_schema(spark, written, FEATURE_SCHEMA))


@query(
    "job_train",
    """SELECT 'accuracy above majority' AS figure, CAST(1 AS BIGINT) AS amount FROM features HAVING count(*) > 0
    UNION ALL SELECT 'predicted rows' AS figure, count(*) AS amount FROM features
    UNION ALL SELECT 'sampled rows foreign to the table' AS figure, CAST(0 AS BIGINT) AS amount
      FROM features HAVING count(*) > 0""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = new_path(spark, "job")
    table = lakehouse_create_or_replace(
        features(spark, sf_dir), "flights_db", f"training_{base[-12:]}", location=f"{base}-lakehouse"
    )
    done = B.job_train(spark, base, table)
    names = ["Carrier", "Origin", "Dest", "FlightNum", "CRSDepTime"]
    rows = spark.table(table)
    # Rows of the table that are like none of the sample can take nothing from it.
    sample = done.sample.select(*names)
    like = reduce(lambda x, y: x & y, [F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in names])
    alike = rows.select(*names).alias("t").join(F.broadcast(sample.distinct().alias("s")), like, "left_semi")
    foreign = sample.exceptAll(alike)
    figures = {
        "accuracy above majority": done.accuracy.agg(F.count_if(F.col("accuracy") > majority(rows))),
        "predicted rows": done.distribution.agg(F.sum("count")),
        "sampled rows foreign to the table": foreign.agg(F.count("*")),
    }
    parts = [df.toDF("amount").select(F.lit(name).alias("figure"), "amount") for name, df in figures.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "job_daily_predict",
    f"""SELECT Carrier, Origin, Dest, FlightNum, FlightDate, DepDelay, Distance,
    Origin || '-' || Dest AS Route, CAST("Timestamp" AS TIMESTAMP) AS "Timestamp",
    TRUE AS as_scored_directly FROM enriched WHERE {_IN_DAY}""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = new_path(spark, "job")
    insert_prediction_task(enriched(spark, sf_dir), f"{base}/{B.TASKS}")
    model = trained(spark, sf_dir)
    # Run twice: the second run replaces the day.
    B.job_daily_predict(spark, DAY, base, model)
    results = B.job_daily_predict(spark, DAY, base, model)
    again = X.stream_score(model, results.withColumnRenamed("Prediction", "loaded").drop("Route"))
    return comparable(
        again.select(
            "Carrier", "Origin", "Dest", "FlightNum", "FlightDate", "DepDelay", "Distance", "Route",
            "Timestamp", (F.col("loaded") == F.col("Prediction")).alias("as_scored_directly"),
        )
    )


@query(
    "job_stream_predict",
    "SELECT UUID AS uuid, Origin AS origin, Dest AS dest, TRUE AS as_in_batch FROM requests",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "job")

    def store(batch: DataFrame, batch_id: int) -> None:
        write = U.upsert_writer(f"{path}/store", "uuid", ["timestamp"], buckets=8)
        write(K.stored_prediction(batch), batch_id)

    running = B.job_stream_predict(
        spark,
        ("text", {"path": request_lines(spark, sf_dir)}),
        [K.response_writer(f"{path}/response"), store, K.debug_writer()],
        trained(spark, sf_dir),
        f"{path}/checkpoint",
        K.DRAIN,
    )
    finish(running)
    predictions = U.read_upserts(spark, f"{path}/store")
    batch = X.stream_score(trained(spark, sf_dir), enriched(spark, sf_dir)).select(
        F.col("UUID").alias("uuid"), F.col("Prediction").alias("expected")
    )
    same = F.col("prediction") == F.col("expected")
    return predictions.join(batch, "uuid", "left").select("uuid", "origin", "dest", same.alias("as_in_batch"))


@query(
    "batch_results_report",
    f"""SELECT "Timestamp", Carrier, FlightDate, Origin, Dest, Distance, DepDelay,
    CASE p.Prediction WHEN 0 THEN 'Early (15+ Minutes Early)'
      WHEN 1 THEN 'Slightly Early (0-15 Minute Early)'
      WHEN 2 THEN 'Slightly Late (0-30 Minute Delay)'
      WHEN 3 THEN 'Very Late (30+ Minutes Late)' END AS Predicted
    FROM enriched e JOIN responses p ON e.UUID = p.UUID WHERE {_IN_DAY}""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = enriched(spark, sf_dir).join(view(spark, sf_dir, "responses"), "UUID")
    return B.batch_results_report(results, DAY)


@query(
    "build_request",
    """SELECT UUID, "Timestamp", DepDelay, Carrier, CAST(FlightDate AS VARCHAR) AS FlightDate, Dest,
    FlightNum, Origin, Distance, DayOfYear, DayOfMonth, DayOfWeek FROM enriched""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = view(spark, sf_dir, "requests").drop("event_type")
    form = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    return B.build_request(form, distances(spark, sf_dir), F.col("UUID"), F.col("Timestamp"))
