"""Cursors, totals counted on the way, and lookups that skip row groups."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from delayflow.operators import lookups as L
from delayflow.operators import ordering as O
from delayflow.registry import QUERIES, ordering, tables
from delayflow.sources.writers import write_clustered
from delayflow.workspace import folders, session_folder
from tests.conftest import SF_DIR

flights_of = tables.flights

COLUMNS = "FlightDate date, DepTime string, Carrier string, FlightNum string, Origin string"


@pytest.fixture
def flights(spark):
    rng = random.Random(4)
    drawn = [
        (rng.choice([None, "2016-01-01", "2016-01-02"]), rng.choice([None, "0900", "1000"]), rng.choice(["AA", None]), rng.choice("12"), rng.choice(["X", None]))
        for _ in range(120)
    ]
    text = spark.createDataFrame(drawn, COLUMNS.replace("date,", "string,", 1))
    return text.withColumn("FlightDate", F.col("FlightDate").cast("date"))


def test_cursors_walk_over_every_row_once(spark, flights):
    order = O.full_order(flights, O.PAGE_ORDER, nulls_last=True)
    expected = [tuple(r) for r in flights.orderBy(*order).collect()]
    assert len(set(expected)) < len(expected)
    for size in (7, 40):
        found, cursor, before = [], None, set(folders(spark, session_folder(spark)))
        while True:
            page, cursor = O.page_after(flights, O.PAGE_ORDER, cursor, size)
            found += [tuple(r) for r in page.orderBy(*order).collect()]
            if cursor is None:
                break
        assert found == expected
        assert set(folders(spark, session_folder(spark))) == before


def test_a_cursor_reaches_the_scan(spark, flights, tmp_path):
    path = str(tmp_path / "clustered")
    write_clustered(flights, path, ["FlightDate"], ["FlightNum"])
    table = spark.read.parquet(path)
    row = ("x",) * 5
    page = table.filter(O._behind(["FlightNum", "Carrier", "Origin"], O.Cursor(row[:3], 1)))
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(FlightNum,x)" in plan


def scanned(df):
    """Rows that the scan of a plan gave out."""
    found = df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    while leaf.nodeName().startswith("AdaptiveSparkPlan"):
        leaf = leaf.executedPlan().collectLeaves().head()
    return found, leaf.metrics().apply("numOutputRows").value()


def test_lookups_skip_row_groups(spark, tmp_path):
    path, total = str(tmp_path / "lookup"), 200_000
    answers = spark.range(total).select(
        F.sha2(F.col("id").cast("string"), 256).alias("UUID"), (F.col("id") % 4).cast("double").alias("Prediction"),
        F.timestamp_seconds(F.col("id")).alias("Timestamp"),
    )
    write_clustered(answers, path, ["Timestamp"], ["UUID"], distinct=10_000, row_group_bytes=512 * 1024)
    table = spark.read.parquet(path)
    known = answers.filter(F.col("Timestamp") == F.timestamp_seconds(F.lit(777))).first()
    found, given = scanned(table.filter(F.col("UUID") == known["UUID"]))
    # Every row group spans all UUIDs, so only Bloom filters can tell them off.
    assert len(found) == 1 and given < total / 4
    assert scanned(table.filter(F.col("UUID") == "8" * 64))[1] < total / 4
    assert scanned(table.filter(F.col("Timestamp") == known["Timestamp"]))[1] < total / 4
    assert L.lookup_prediction_status(table, known["UUID"]).first()["Prediction"] == known["Prediction"]


def test_a_page_and_its_total_read_the_table_once(spark, flights, tmp_path):
    path = str(tmp_path / "flights")
    flights.coalesce(1).write.parquet(path)
    table = spark.read.parquet(path)
    page = L.search_page(table, start=15, Carrier="AA")
    total = flights.filter("Carrier = 'AA'").count()
    row = page.first()
    expected = L.search_flights(flights, start=15, Carrier="AA").collect()
    assert row["total"] == total and [tuple(r) for r in row["flights"]] == [tuple(r) for r in expected]
    # What is handed on reads the stored page alone.
    assert all("/page-" in f for f in page.inputFiles())
    beyond = L.search_page(table, start=1_000_000, Carrier="AA").first()
    assert beyond["total"] == total and beyond["flights"] == []
    assert L.search_page(table, Carrier="none").first()["total"] == 0


@pytest.mark.parametrize("key", ["page_after", "page_after_deep"])
def test_pages_in_turn_read_flights_that_are_joined_once(spark, key, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(tables, "flights", lambda *a: made.append(a) or flights_of(*a))
    monkeypatch.setattr(ordering, "flights", tables.flights)
    monkeypatch.setattr(tables, "_stored", {})
    assert QUERIES[key](spark, SF_DIR).count() == 15
    assert len(made) == 1
