"""One key, or one row, holding a third of everything."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from delayflow.operators import joins as J
from delayflow.operators import ordering as O
from delayflow.operators import summaries as S
from delayflow.streaming.sinks import latest_per_key
from tests.conftest import rows


@pytest.fixture(scope="module")
def hot(spark):
    """Flights of which a third belong to one airplane, and as many are one and the same."""
    flights = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("N0")).otherwise(F.concat(F.lit("N"), F.col("id") % 97)).alias("TailNum"),
        F.lit("AA").alias("Carrier"),
        F.lit("2016-12-25").cast("date").alias("FlightDate"),
        F.when(F.col("id") % 3 == 1, F.lit("7")).otherwise(F.col("id").cast("string")).alias("FlightNum"),
        F.lit("X").alias("Origin"),
        F.lit("Y").alias("Dest"),
    )
    return flights


def test_documents_of_a_hot_key_are_split_and_whole(hot):
    limit = 500
    documents = S.flights_per_airplane(hot, max_items=limit).persist()
    sizes = documents.select(F.size("Flights")).collect()
    assert max(s[0] for s in sizes) < 2 * limit
    assert documents.filter("TailNum = 'N0'").count() > 10
    flat = documents.select("TailNum", F.inline("Flights"))
    assert flat.agg(F.sum("Copies")).first()[0] == 30_000
    expected = Counter((r.TailNum, r.FlightNum) for r in hot.select("TailNum", "FlightNum").collect())
    assert Counter({(r.TailNum, r.FlightNum): r.Copies for r in flat.collect()}) == expected
    documents.unpersist()


def test_fleet_of_a_hot_carrier(hot):
    whole = S.airplanes_per_carrier(hot)
    split = S.airplanes_per_carrier(hot, max_items=20)
    assert whole.count() == 1 and split.count() > 1
    assert {r.FleetCount for r in split.collect()} == {97}
    tails = rows(split.select(F.explode("TailNumbers")))
    assert tails == rows(whole.select(F.explode("TailNumbers")))


def test_copies_are_sorted_by_many_tasks(spark):
    copies = spark.range(0, 40_000, 1, 8).select(F.lit("same").alias("x"))
    ordered = O.sort_rows(copies, ["x"]).withColumn("task", F.spark_partition_id())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counts = [r["count"] for r in ordered.groupBy("task").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(counts) == 40_000
    assert len(counts) == 4 and max(counts) < 20_000


@pytest.fixture
def small_partitions(spark):
    """Thresholds at which the small fixtures count as large."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key in changed:
        spark.conf.unset(key)


def _final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_large_dimension_join_splits_the_hot_key(spark, small_partitions):
    requests = spark.range(0, 60_000, 1, 8).select(
        F.col("id").cast("string").alias("UUID"),
        F.when(F.col("id") % 3 == 0, F.lit("A0")).otherwise(F.concat(F.lit("A"), F.col("id") % 500)).alias("Origin"),
        F.lit("B").alias("Dest"),
    )
    dim = spark.range(500).select(
        F.concat(F.lit("A"), F.col("id")).alias("Origin"), F.lit("B").alias("Dest"),
        F.col("id").cast("double").alias("Distance"),
    )
    joined = J.enrich_distance(requests, dim, broadcast_bytes=0)
    assert "skew=true" in _final_plan(joined)
    assert joined.count() == 60_000
    assert joined.agg(F.sum("Distance")).first()[0] == sum(i % 500 for i in range(60_000) if i % 3)


def test_correlation_splits_requests_without_id(spark, small_partitions):
    requests = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("UUID"), F.col("id").alias("n")
    )
    responses = requests.select("UUID", (F.col("n") % 4).cast("double").alias("Prediction"))
    paired = J.correlate_request_response(requests, responses)
    assert "skew=true" in _final_plan(paired)
    assert {r["status"]: r["count"] for r in paired.groupBy("status").count().collect()} == {
        "OK": 40_000, "WAIT": 20_000,
    }


def test_small_dimension_is_broadcast_and_facts_stay_put(spark):
    requests = spark.range(1000).select(
        F.concat(F.lit("A"), F.col("id") % 5).alias("Origin"),
        F.concat(F.lit("B"), F.col("id") % 3).alias("Dest"),
    )
    dim = spark.createDataFrame([("A1", "B1", 5.0)], "Origin string, Dest string, Distance double")
    plan = J.enrich_distance(requests, dim)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_latest_per_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select(F.lit("k").alias("key"), F.col("id").alias("at"))
    latest = latest_per_key(df, "key", ["at"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    assert rows(latest) == [("k", 999)]


def test_the_null_key_is_split_and_kept(spark, hot):
    none = hot.select(
        F.when(F.col("TailNum") != "N0", F.col("TailNum")).alias("TailNum"),
        F.when(F.col("TailNum") != "N5", F.col("Carrier")).alias("Carrier"),
        "FlightDate", "FlightNum", "Origin", "Dest",
    )
    documents = S.flights_per_airplane(none, max_items=500)
    unknown = documents.filter("TailNum IS NULL").select(F.size("Flights")).collect()
    assert len(unknown) > 10 and max(s[0] for s in unknown) < 1_000
    fleets = {r.Carrier: r.FleetCount for r in S.airplanes_per_carrier(none, max_items=20).collect()}
    assert fleets == {"AA": 95, None: 1}


def test_all_predictions_are_counted(spark):
    df = spark.createDataFrame(
        [(0.0, 7.0), (0.0, None), (0.0, 1.0), (None, 2.0)], "label double, Prediction double"
    )
    found = {r.label: tuple(r)[1:] for r in S.confusion_matrix(df).collect()}
    assert found == {0.0: (0, 1, 0, 0, 1, 1), None: (0, 0, 1, 0, 0, 0)}
