"""Table operators on small frames."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from delayflow.operators import joins as J
from delayflow.operators import lookups as L
from delayflow.operators import ordering as O
from delayflow.operators import projection as P
from delayflow.operators import summaries as S
from delayflow.registry.projections import copies_of
from delayflow.registry.tables import flights, view
from delayflow.workspace import folders, materialize, session_folder
from tests.conftest import rows

FLIGHT = "FlightNum string, FlightDate date, Carrier string, Origin string, Dest string, " \
    "TailNum string, DepTime string, ArrTime string"


@pytest.fixture(scope="module")
def stored_flights(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables") / "flights")
    flights(spark, "/root/testdata/sf0.001").write.parquet(path)
    return spark.read.parquet(path)


def test_route_is_null_without_an_end(spark):
    df = spark.createDataFrame([("A", "B"), (None, "B")], "Origin string, Dest string")
    assert [r.Route for r in P.derive_route(df).collect()] == ["A-B", None]


def test_drop_rename_ignores_absent_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "prediction double, Carrier_index double")
    assert P.drop_rename_columns(df).columns == ["Prediction"]


def test_coerce_request_fields(spark):
    df = spark.createDataFrame([("5.5", "AA"), ("abc", None)], "DepDelay string, Carrier string")
    typed = P.coerce_request_fields(df)
    assert [r.DepDelay for r in typed.collect()] == [5.5, None]
    assert dict(typed.dtypes)["Origin"] == "string"
    whole = P.coerce_request_fields(df, {"DepDelay": "int"})
    assert [r.DepDelay for r in whole.collect()] == [None, None]


def test_samples(spark):
    df = spark.range(20_000)
    assert abs(P.sample_bernoulli(df, 0.1, 27).count() - 2000) < 300
    keyed = P.sample_bernoulli(df, 0.1, 27, key=["id"])
    spread = P.sample_bernoulli(df.repartition(13), 0.1, 27, key=["id"])
    assert abs(keyed.count() - 2000) < 300
    assert rows(keyed) == rows(spread)


def test_lookup_flight_takes_missing_arguments_as_null(spark):
    data = [("1", None, "AA", "X", "Y", "N1", None, None), ("2", None, "AA", "X", "Y", "N1", None, None)]
    df = spark.createDataFrame(data, FLIGHT)
    assert [r.FlightNum for r in L.lookup_flight(df, "AA", None, "2").collect()] == ["2"]
    assert L.lookup_flight(df, None, None, "2").count() == 0


def test_list_route_flights_puts_missing_times_first(spark):
    day = "2016-12-25"
    data = [("1", "0900", "1000"), ("2", None, "0800"), ("3", "0700", None), ("4", "0700", "0800")]
    df = spark.createDataFrame(data, "FlightNum string, DepTime string, ArrTime string").select(
        "*", F.lit("X").alias("Origin"), F.lit("Y").alias("Dest"), F.lit(day).cast("date").alias("FlightDate")
    )
    assert [r.FlightNum for r in L.list_route_flights(df, "X", "Y", day).collect()] == ["2", "3", "4", "1"]


def test_search_terms_are_optional(stored_flights):
    everything = L.matching_flights(stored_flights, Carrier=None, Origin="").count()
    assert everything == stored_flights.count()
    one = L.matching_flights(stored_flights, Carrier="C01", Origin="A03")
    assert rows(one) == rows(stored_flights.filter("Carrier = 'C01' AND Origin = 'A03'"))
    assert S.search_total(stored_flights, Carrier="nobody").first()["total"] == 0
    assert L.matching_flights(stored_flights, FlightDate="some day").count() == 0
    with pytest.raises(ValueError):
        L.matching_flights(stored_flights, Pilot="x")


def test_search_airplanes_without_terms_is_first_page(spark, sf_dir):
    airplanes = view(spark, sf_dir, "airplanes")
    page = L.search_airplanes(airplanes).collect()
    assert len(page) == 5 and all(r.score == 0 for r in page)
    owners = sorted(r.Owner for r in airplanes.select("Owner").collect())
    assert [r.Owner for r in page] == owners[:5]


def test_requests_in_day_compares_text(spark):
    stamps = ["2016-12-25T00:00:00", "2016-12-26", "2016-12-26T00:00:00", "2016-12-24T23:59:59"]
    df = spark.createDataFrame([(s,) for s in stamps], "Timestamp string")
    assert rows(L.requests_in_day(df, "2016-12-25")) == [("2016-12-25T00:00:00",), ("2016-12-26",)]
    assert rows(L.requests_in_day(df, "2016-12-25", half_open=True)) == [("2016-12-25T00:00:00",)]


def test_prediction_status(spark):
    df = spark.createDataFrame([("a", 2.0)], "UUID string, Prediction double")
    assert rows(L.lookup_prediction_status(df, "a")) == [("a", "OK", 2.0)]
    assert rows(L.lookup_prediction_status(df, "b")) == [("b", "WAIT", None)]


def test_distance_of_unknown_pair_is_zero(spark):
    requests = spark.createDataFrame(
        [("1", "A", "B"), ("2", "A", "Z"), ("3", None, "B")], "UUID string, Origin string, Dest string"
    )
    dim = spark.createDataFrame([("A", "B", 99.7)], "Origin string, Dest string, Distance double")
    for limit in (J.BROADCAST_BYTES, 0):
        found = J.enrich_distance(requests, dim, limit).select("UUID", "Distance")
        assert rows(found) == [("1", 99), ("2", 0), ("3", 0)]
        lost = J.unmatched_routes(requests, dim, limit).select("UUID")
        assert rows(lost) == [("2",), ("3",)]


def test_correlation_takes_one_response(spark):
    requests = spark.createDataFrame([("a",), ("b",), (None,)], "UUID string")
    responses = spark.createDataFrame(
        [("a", 3.0), ("a", 1.0), ("c", 2.0), (None, 0.0)], "UUID string, Prediction double"
    )
    paired = J.correlate_request_response(requests, responses)
    assert rows(paired) == [("a", 1.0, "OK"), ("b", None, "WAIT"), (None, None, "WAIT")]


def test_profile_keeps_both_sides(spark):
    airlines = spark.createDataFrame([("AA", "Alpha"), ("BB", "Beta")], "CarrierCode string, Name string")
    fleet = spark.createDataFrame([("BB", 2), ("CC", 3)], "Carrier string, FleetCount int")
    assert rows(J.airline_profile(airlines, fleet)) == [
        ("AA", "Alpha", None), ("BB", "Beta", 2), ("CC", None, 3),
    ]


def test_null_counts_match_one_count_per_column(stored_flights):
    expected = {
        c: n for c in stored_flights.columns
        if (n := stored_flights.filter(F.col(c).isNull()).count()) > 0
    }
    assert {r["column"]: r["nulls"] for r in S.null_counts(stored_flights).collect()} == expected


def test_confusion_matrix_has_all_classes(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 3.0), (2.0, 2.0)], "label double, Prediction double")
    assert rows(S.confusion_matrix(df)) == [(0.0, 1, 0, 0, 1, 0, 0), (2.0, 0, 0, 1, 0, 0, 0)]
    assert S.accuracy(df).first()["accuracy"] == pytest.approx(2 / 3)


def test_delay_bins_include_their_lower_end(spark):
    df = spark.createDataFrame([(-15.0,), (-0.5,), (0.0,), (14.9,), (None,)], "d double")
    assert rows(S.delay_histogram(df, "d", 15)) == [(-15.0, 2), (0.0, 2)]


def test_nav_offsets(spark):
    df = spark.createDataFrame([(0, 15, 40), (30, 45, 40)], "start int, end int, total int")
    first, last = O.nav_offsets(df).orderBy("start").collect()
    assert (first.next_top, first.next_bottom, first.previous_top, first.previous_bottom) == (30, 15, 0, 0)
    assert (first.next_shown, first.previous_shown) == (True, False)
    assert (last.next_shown, last.previous_shown) == (False, True)


def test_pages_put_together_are_the_sorted_table(stored_flights):
    part = stored_flights.filter("Carrier = 'C01' AND Origin = 'A03'").union(
        stored_flights.filter("DepTime IS NULL").limit(20)
    )
    keys = O.full_order(part, O.PAGE_ORDER, nulls_last=True)
    whole = [tuple(r) for r in part.orderBy(*keys).collect()]
    pages = []
    for start in range(0, len(whole) + 15, 15):
        pages += [tuple(r) for r in O.page_flights(part, start).collect()]
    assert pages == whole


def test_paging_skips_sort_columns_that_are_missing(spark):
    df = spark.createDataFrame([("2", "b"), ("1", None), ("1", "a")], "Carrier string, x string")
    assert [tuple(r) for r in O.page_flights(df, 0, 2).collect()] == [("1", "a"), ("1", None)]


@pytest.mark.parametrize("top, values", [(0, 100_000), (45, 100_000), (45, 3)])
def test_deep_pages_equal_shallow_ones(stored_flights, monkeypatch, top, values):
    names = O.page_names(stored_flights, ["Carrier", "Month", *O.PAGE_ORDER])
    rows_in = stored_flights.limit(2_000).unionByName(stored_flights.limit(3)).unionByName(stored_flights.limit(3))
    stored = materialize(rows_in, "paged")
    whole = [tuple(r) for r in stored.orderBy(*[F.col(c).asc_nulls_last() for c in names]).collect()]
    monkeypatch.setattr(O, "TOP_K_ROWS", top)
    monkeypatch.setattr(O, "MAX_VALUES", values)
    first = sum(r[stored.columns.index("Carrier")] == whole[0][stored.columns.index("Carrier")] for r in whole)
    for start in (700, first - 3, len(whole) - 5, len(whole), len(whole) + 100):
        page = [tuple(r) for r in O.page_by(stored, names, start, 40).collect()]
        assert page == whole[start : start + 40]


def test_pages_by_counts_store_nothing(spark, stored_flights):
    before = folders(spark, session_folder(spark))
    page = O.page_flights(stored_flights, 3_000)
    assert page.count() == 15 and folders(spark, session_folder(spark)) == before


def test_pages_of_one_ordered_table_skip_by_id(stored_flights):
    keys = O.full_order(stored_flights, O.PAGE_ORDER, nulls_last=True)
    ordered = O.ordered_table(stored_flights, keys)
    whole = [tuple(r) for r in stored_flights.orderBy(*keys).collect()]
    for start in (0, 700, len(whole) - 5, len(whole), len(whole) + 100):
        page = O.page_of_ordered(ordered, start, 40)
        assert [tuple(r) for r in page.collect()] == whole[start : start + 40]
    plan = O.page_of_ordered(ordered, 700, 40)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].split("]")[0]
    assert "GreaterThanOrEqual(_id" in pushed and "LessThanOrEqual(_id" in pushed
    assert O.page_of_ordered(O.ordered_table(stored_flights.limit(0), keys), 0, 40).count() == 0


def test_page_without_hits_has_a_total(stored_flights):
    page = L.search_page(stored_flights, Carrier="none").first()
    assert page.total == 0 and page.flights == [] and not page.next_shown
    whole = L.search_page(stored_flights, start=15).first()
    assert whole.total == stored_flights.count() and len(whole.flights) == 15
    assert whole.next_shown and whole.previous_shown
    assert [tuple(r) for r in whole.flights] == [tuple(r) for r in O.page_flights(stored_flights, 15).collect()]


def test_number_rows_counts_in_order(spark):
    numbers = list(range(5000))
    random.Random(1).shuffle(numbers)
    df = spark.createDataFrame([(n,) for n in numbers], "n int").repartition(7)
    placed = O.number_rows(df, [F.col("n").desc()], "place")
    assert placed.filter(F.col("place") != 4999 - F.col("n")).count() == 0
    assert placed.count() == 5000


def test_sort_features_is_in_order(spark, sf_dir):
    from delayflow.registry.tables import features

    ordered = O.sort_features(features(spark, sf_dir))
    got = [tuple(r) for r in ordered.select(*O.FEATURE_ORDER).collect()]
    # Missing values come first.
    assert got == sorted(got, key=lambda r: [(x is not None, x) for x in r])


def test_longest_and_shortest(spark):
    df = spark.createDataFrame([("A", "B", 3.0), ("A", "C", 1.0), ("B", "C", 2.0)], "Origin string, Dest string, Distance double")
    assert [r.Distance for r in O.longest_shortest_routes(df, 2).collect()] == [3.0, 2.0]
    assert [r.Distance for r in O.longest_shortest_routes(df, 1, longest=False).collect()] == [1.0]


def test_the_first_response_in_time_counts(spark):
    asked = spark.createDataFrame([("a",), ("b",), (None,)], "UUID string")
    said = spark.createDataFrame(
        [("a", "2024-01-02", 1.0), ("a", "2024-01-01", 3.0), ("a", None, 0.0)],
        "UUID string, Timestamp string, Prediction double",
    )
    found = {r.UUID: (r.Prediction, r.status) for r in J.correlate_request_response(asked, said).collect()}
    assert found == {"a": (3.0, "OK"), "b": (None, "WAIT"), None: (None, "WAIT")}


def test_requests_without_a_day_are_found_by_their_text(spark):
    tasks = spark.createDataFrame(
        [("2024-01-15x", None), ("2024-01-15T10", "2024-01-15"), ("2024-02-01", "2024-02-01")],
        "Timestamp string, iso_date string",
    ).withColumn("iso_date", F.col("iso_date").cast("date"))
    assert L.requests_in_day(tasks, "2024-01-15").count() == 2
    assert L.requests_in_day(tasks.drop("iso_date"), "2024-01-15").count() == 2


def test_copies_in_a_table_and_its_samples(spark):
    whole = spark.createDataFrame([(1, None), (1, None), (2, "b"), (None, "c")], "a int, b string")
    one = spark.createDataFrame([(1, None), (2, "b"), (2, "b")], "a int, b string")
    other = spark.createDataFrame([(9, "z")], "a int, b string")
    copies = copies_of(whole, {"one": one, "other": other}, 3)
    text = copies._jdf.queryExecution().executedPlan().toString()
    assert rows(copies) == sorted(
        [(1, None, 2, 1, 0), (2, "b", 1, 2, 0), (None, "c", 1, 0, 0), (9, "z", 0, 0, 1)], key=str
    )
    # One shuffle, whose width follows the rows.
    assert text.count("Exchange") == 1 and "3), REPARTITION_BY_NUM" in text
