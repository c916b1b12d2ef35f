"""Readers and writers: round trips, reruns and pushdown."""

from __future__ import annotations

import bz2
import json
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from delayflow import registry, workspace
from delayflow.registry.tables import features, flights, table, view
from delayflow.operators.lookups import matching_flights, requests_in_day
from delayflow.schemas import BATCH_REQUEST_SCHEMA, FEATURE_SCHEMA
from delayflow.sources import readers as R
from delayflow.sources import writers as W
from delayflow.workspace import CHECKPOINT_SETTING, materialize, new_path, shared_root
from tests.conftest import rows

RECORD = {
    "Carrier": "QX", "FlightNum": "17", "Origin": "BOI", "Dest": "GEG", "Distance": 287.0,
    "FlightDate": "2019-07-04T19:00:00.000-05:00", "DayOfYear": 186, "DayOfMonth": 5, "DayOfWeek": 5,
    "CRSDepTime": "2019-07-04T22:40:00.000-05:00", "CRSArrTime": "2019-07-04T23:55:00.000-05:00",
    "DepDelay": 21.0, "ArrDelay": 9.0,
}


def test_bz2_records_get_the_declared_types(spark, tmp_path):
    path = str(tmp_path / "features.jsonl.bz2")
    Path(path).write_bytes(bz2.compress((json.dumps(RECORD) + "\n").encode()))
    inferred = R.scan_json_inferred_bz2(spark, path)
    assert dict(inferred.dtypes)["DayOfWeek"] == "bigint"
    declared = R.scan_json_inferred_bz2(spark, path, FEATURE_SCHEMA)
    assert [(f.name, f.dataType) for f in declared.schema] == [
        (f.name, f.dataType) for f in FEATURE_SCHEMA
    ]
    row = declared.select("*", F.date_format("CRSDepTime", "HH:mm").alias("clock")).first()
    # The instant written with an offset lies on the next day in UTC.
    assert str(row.FlightDate) == "2019-07-05"
    assert (row.clock, row.DayOfWeek, row.ArrDelay) == ("03:40", 5, 9.0)


def test_inference_sees_the_last_record_of_any_codec(spark, sf_dir, tmp_path):
    # Both queries scan all records; only the one named after it takes the time of bzip2.
    registry.load()
    files = {name: registry.QUERIES[name](spark, sf_dir).inputFiles() for name in ("scan_json_inferred", "scan_json_inferred_bz2")}
    assert all(f.endswith(".json.gz") for f in files["scan_json_inferred"])
    assert all(f.endswith(".json.bz2") for f in files["scan_json_inferred_bz2"])
    number = spark.range(20_000).coalesce(1)
    shown = F.when(F.col("id") == 19_999, "0.5").otherwise(F.col("id").cast("string"))
    for codec in ("gzip", "bzip2"):
        path = str(tmp_path / codec)
        text = F.concat(F.lit('{"n": '), shown, F.lit("}"))
        number.select(text.alias("value")).write.option("compression", codec).text(path)
        found = R.scan_json_inferred_bz2(spark, path)
        assert found.dtypes == [("n", "double")] and found.count() == 20_000


def test_absent_json_fields_are_null(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"Carrier":"AA","DepDelay":-3}\n')
    row = R.scan_json_schema(spark, str(tmp_path), BATCH_REQUEST_SCHEMA).first()
    assert (row.Carrier, row.DepDelay, row.Origin, row.Timestamp) == ("AA", -3.0, None, None)


def test_range_scan_is_pushed_down(spark, sf_dir):
    df = R.store_scan_with_range(spark, f"{sf_dir}/events.parquet", "ts", "2024-01-15", "2024-01-16")
    plan = df.select("event_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThanOrEqual(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_search_terms_reach_the_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "flights")
    flights(spark, sf_dir).write.parquet(path)
    found = matching_flights(R.scan_parquet(spark, path), Carrier="C01", FlightDate="1996-12-17")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(Carrier,C01)" in plan and "EqualTo(FlightDate,1996-12-17)" in plan


def test_a_scan_never_shuffles_and_the_fixture_is_spread(spark, sf_dir):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    whole = R.scan_parquet(spark, f"{sf_dir}/lineitem.parquet")
    assert "Exchange" not in plan(whole)
    # At the size of the benchmark a scan has several splits but one of them has all rows.
    for folder in (sf_dir, sf_dir.replace("sf0.001", "sf0.1")):
        spread = table(spark, folder, "lineitem")
        assert "REPARTITION_BY_NUM" in plan(spread)
        sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) < 2 * sum(sizes) / len(sizes)


def test_table_is_created_and_replaced(spark, sf_dir):
    place = new_path(spark, "lakehouse")
    name = W.lakehouse_create_or_replace(spark.range(3), "lake_db", "numbers", location=place)
    assert R.scan_catalog_table(spark, name).count() == 3
    W.lakehouse_create_or_replace(spark.range(5).withColumn("x", F.lit(1)), "lake_db", "numbers")
    assert R.scan_catalog_table(spark, name).columns == ["id", "x"]
    assert R.scan_catalog_table(spark, name).count() == 5


def test_single_file_keeps_the_order(spark, tmp_path):
    path = tmp_path / "one"
    W.write_json_single(spark.range(100).repartition(5), str(path), [F.col("id").desc()], one_file=True)
    files = list(path.glob("part-*"))
    assert len(files) == 1
    assert [json.loads(x)["id"] for x in files[0].read_text().splitlines()] == list(range(99, -1, -1))


def test_large_ordered_output_stays_in_several_files(spark, tmp_path):
    path = tmp_path / "many"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        W.write_json_single(spark.range(1000).repartition(5), str(path), ["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = sorted(path.glob("part-*"))
    assert len(files) > 1
    lines = [json.loads(x)["id"] for f in files for x in f.read_text().splitlines()]
    assert lines == list(range(1000))


def test_day_rerun_replaces_that_day_only(spark, tmp_path):
    path = str(tmp_path / "daily")
    days = spark.createDataFrame(
        [("a", "2024-01-01"), ("b", "2024-01-02"), ("c", "2024-01-02")], "x string, iso_date string"
    )
    W.daily_partition_overwrite(days, path)
    read = lambda: rows(spark.read.schema("x string, iso_date string").json(path))
    W.daily_partition_overwrite(spark.createDataFrame([("d",)], "x string"), path, "2024-01-02")
    assert read() == [("a", "2024-01-01"), ("d", "2024-01-02")]
    # A rerun without rows empties the day.
    W.daily_partition_overwrite(spark.createDataFrame([], "x string"), path, "2024-01-02")
    assert read() == [("a", "2024-01-01")]


@pytest.mark.parametrize("idempotent, copies", [(True, 1), (False, 2)])
def test_append_results(spark, tmp_path, idempotent, copies):
    path = str(tmp_path / "results")
    day = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "UUID string, Prediction double")
    W.append_results(day, path, "2024-01-01", idempotent)
    W.append_results(day, path, "2024-01-02", idempotent)
    W.append_results(day, path, "2024-01-02", idempotent)
    found = spark.read.parquet(path).groupBy("iso_date").count().orderBy("iso_date").collect()
    assert [r["count"] for r in found] == [2, 2 * copies]


def test_distance_table_has_one_truncated_row_per_pair(spark, tmp_path):
    routes = spark.createDataFrame(
        [("A", "B", 10.9), ("A", "B", 7.0), ("B", "A", -1.5)], "Origin string, Dest string, Distance double"
    )
    dim = W.load_distance_dim(routes, str(tmp_path / "dim"))
    assert rows(dim) == [("A", "B", 10), ("B", "A", -1)]
    assert dict(dim.dtypes)["Distance"] == "int"


def test_text_round_trip(spark, sf_dir, tmp_path):
    requests = view(spark, sf_dir, "requests")
    W.write_json_text(requests, str(tmp_path / "t"))
    back = R.read_text_parse_json(spark, str(tmp_path / "t"), requests.schema)
    assert rows(back) == rows(requests)


def test_tasks_accumulate(spark, sf_dir, tmp_path):
    requests = view(spark, sf_dir, "requests")
    for _ in range(2):
        W.insert_prediction_task(requests, str(tmp_path / "tasks"))
    tasks = spark.read.parquet(str(tmp_path / "tasks"))
    assert tasks.count() == 2 * requests.count()
    day = requests_in_day(tasks, "2024-01-15")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*iso_date", plan)
    assert day.count() == 2 * requests_in_day(requests, "2024-01-15").count()


def test_intermediate_tables_can_be_cleared(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(workspace, "session_folder", lambda spark: str(tmp_path / "application"))
    kept = materialize(spark.range(3), "numbers")
    assert kept.count() == 3 and (tmp_path / "application").exists()
    workspace.clear(spark)
    assert not (tmp_path / "application").exists()


def test_intermediate_tables_go_to_the_shared_folder(spark, sf_dir):
    root = spark.conf.get(CHECKPOINT_SETTING)
    assert shared_root(spark) == root.rstrip("/")
    stored = materialize(features(spark, sf_dir), "features")
    assert all(f.removeprefix("file://").startswith(root) for f in stored.inputFiles())
