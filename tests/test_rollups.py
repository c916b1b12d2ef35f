"""Partial counts by day against full recomputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from delayflow.operators import rollups as R
from delayflow.operators import summaries as S
from delayflow.registry import summaries as registered
from tests.conftest import SF_DIR, rows

COLUMNS = "Year int, Month int, Carrier string, TailNum string, FlightDate string, FlightNum string, Origin string, Dest string"


def day(spark, n, number):
    items = [
        (2016, 1 + i % 3, ["AA", None, "BB"][i % 3], None if i % 3 == 2 else f"N{i % 5}", f"2016-01-{number:02d}", str(i % 4), "X", "Y")
        for i in range(n)
    ]
    return spark.createDataFrame(items, COLUMNS)


def test_three_loads_equal_a_full_recompute(spark, tmp_path):
    path, loads = str(tmp_path / "partials"), {1: 40, 2: 0, 3: 25}
    R.merge_day(day(spark, 99, 3), path, "2024-01-03")
    for number, n in loads.items():
        R.merge_day(day(spark, n, number), path, f"2024-01-{number:02d}")
    whole = day(spark, 40, 1).union(day(spark, 25, 3))
    assert rows(R.months_so_far(spark, path)) == rows(S.flights_by_month(whole))
    fleets = R.fleets_so_far(spark, path)
    assert rows(fleets) == rows(S.airplanes_per_carrier(whole))
    assert {r.Carrier: r.FleetCount for r in fleets.collect()} == {"AA": 5, None: 5, "BB": 0}
    assert rows(R.airplanes_so_far(spark, path)) == rows(S.flights_per_airplane(whole))
    # A summary reads partials alone.
    assert all("/partials/" in f for f in R.months_so_far(spark, path).inputFiles())
    assert spark.read.parquet(f"{path}/months").agg(F.sum(R.ROWS)).first()[0] == 65


def test_loads_read_flights_that_are_joined_once(spark, monkeypatch):
    # Four loads, of a table that is stored: none of them has the joins in its plan.
    plans = []
    monkeypatch.setattr(registered.R, "merge_day", lambda df, *a: plans.append(df._jdf.queryExecution().toString()))
    monkeypatch.setattr(registered, "stored_path", lambda s, d, n, write: write("unused"))
    registered._loaded(spark, SF_DIR)
    assert len(plans) == 4 and not any("Join" in p for p in plans)
