"""Edge rows of the column expressions."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from delayflow.functions import labels, text, times, values
from delayflow.operators.learning import arrival_class


def evaluate(spark, kind, items, expression):
    """The expression's value for each item, in order."""
    df = spark.createDataFrame(list(enumerate(items)), f"i int, x {kind}")
    shown = df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()
    return [r["y"] for r in shown]


def test_hhmm_to_time(spark):
    cases = {
        "0005": "00:05", "1530": "15:30", "2400": "23:59", "2417": "23:59", "905": "09:05",
        "5": "00:05", "2359": "23:59", "2500": None, "0960": None, "12x4": None, "": None, None: None,
    }
    assert evaluate(spark, "string", cases, times.hhmm_to_time) == list(cases.values())


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 24), st.integers(0, 59)), min_size=20, max_size=60))
def test_clock_matches_python(spark, clocks):
    expected = ["23:59" if h == 24 else f"{h:02d}:{m:02d}" for h, m in clocks]
    given_text = [f"{h:02d}{m:02d}" for h, m in clocks]
    assert evaluate(spark, "string", given_text, times.hhmm_to_time) == expected


def test_compose_timestamp_is_utc_in_any_session_zone(spark):
    try:
        for zone in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            seconds = evaluate(
                spark, "string", ["2400", "0905"],
                lambda x: F.unix_seconds(times.compose_timestamp(F.lit("2015-12-31"), x)),
            )
            day = int(dt.datetime(2015, 12, 31, tzinfo=dt.timezone.utc).timestamp())
            assert seconds == [day + 86_340, day + 32_700]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_overnight_rollover(spark):
    df = spark.createDataFrame(
        [("2350", "0010"), ("0800", "0800"), ("0800", "0930")], "dep string, arr string"
    )
    day = F.lit("2016-02-28")
    dep, arr = times.compose_timestamp(day, F.col("dep")), times.compose_timestamp(day, F.col("arr"))
    shown = df.select(F.date_format(times.overnight_rollover(dep, arr), "MM-dd HH:mm")).collect()
    assert [r[0] for r in shown] == ["02-29 00:10", "02-28 08:00", "02-28 09:30"]


def test_date_parts(spark):
    df = spark.createDataFrame([("2016-12-25",), ("2015-12-31",)], "FlightDate string")
    served = times.request_date_parts(df).collect()
    assert [(r.DayOfYear, r.DayOfMonth, r.DayOfWeek) for r in served] == [(360, 25, 6), (365, 31, 3)]
    trained = times.request_date_parts(df, monday=1).collect()
    assert [r.DayOfWeek for r in trained] == [7, 4]
    assert evaluate(spark, "string", ["2015-12-31"], lambda x: times.training_weekday(x.cast("date"))) == [4]


def test_iso_day_bounds(spark):
    bounds = evaluate(spark, "string", ["2016-12-31T23:59:00"], times.iso_day_bounds)[0]
    assert (bounds.iso_today, bounds.iso_tomorrow) == ("2016-12-31", "2017-01-01")


def test_month_day_string(spark):
    made = evaluate(spark, "int", [3, None], lambda x: times.month_day_string(x, F.lit("07")))
    assert made == ["3-07", None]


def test_arrival_class(spark):
    cases = {-100.0: 0, -15.0: 1, -0.1: 1, 0.0: 2, 29.9: 2, 30.0: 3, 1e9: 3, None: None}
    assert evaluate(spark, "double", cases, arrival_class) == list(cases.values())
    with pytest.raises(Exception, match="not a number"):
        evaluate(spark, "double", [float("nan")], arrival_class)


def test_truncate_label(spark):
    cases = {"a" * 15: "a" * 14 + "...", "b" * 14: "b" * 14, "": "", None: None}
    assert evaluate(spark, "string", cases, text.truncate_label) == list(cases.values())


def test_strip_paging_from_url(spark):
    cases = {
        "http://h/f?start=0&end=15": "http://h/f",
        "http://h/f?Carrier=AA&start=0&end=15": "http://h/f?Carrier=AA&start=0&end=15",
        "http://h/f?start=&end=15": "http://h/f?start=&end=15",
        "http://h/f": "http://h/f",
        None: None,
    }
    assert evaluate(spark, "string", cases, text.strip_paging_from_url) == list(cases.values())


def test_parse_json(spark):
    schema = StructType().add("DepDelay", "double").add("FlightNum", "string")
    parsed = evaluate(
        spark, "string", ["not json", '{"DepDelay":"x","FlightNum":"1"}', None, '{"DepDelay":2.5}'],
        lambda x: text.parse_json(x, schema),
    )
    assert tuple(parsed[0]) == (None, None)
    assert tuple(parsed[1]) == (None, "1")
    assert parsed[2] is None
    assert tuple(parsed[3]) == (2.5, None)


def test_to_json_record_leaves_nulls_out(spark):
    df = spark.createDataFrame([("a", None)], "x string, y int")
    assert text.to_json_record(df).first()["value"] == '{"x":"a"}'


def test_value_to_string(spark):
    assert evaluate(spark, "binary", [b"\xc3\xa9t\xc3\xa9"], text.value_to_string) == ["été"]


def test_search_tokens(spark):
    tokens = evaluate(spark, "string", ["Blue  widget, BLUE #7"], text.search_tokens)[0]
    assert sorted(tokens) == ["7", "blue", "widget"]


def test_labels(spark):
    minutes = evaluate(spark, "string", ["0", "3.0", "4", "x", None], labels.decode_label_minutes)
    assert minutes == [
        "Early (15+ Minutes Early)", "Very Late (30+ Minutes Late)", None, None, None,
    ]
    batch = evaluate(spark, "double", [0.0, 2.0, 3.0, None], labels.decode_label_batch)
    assert batch == ["On Time (0-15 Minute Delay)", "Very Late (60+ Minute Delay)", "", ""]
    short = evaluate(spark, "double", [1.0, 3.0, 7.0], labels.decode_label_short)
    assert short == ["Slight delay", "Extremely late", "7.0"]


def test_casts_and_defaults(spark):
    df = spark.createDataFrame([("-3.9", None), ("12", "7"), ("no", "")], "start string, end string")
    cast = values.int_casts(df, ["start"]).collect()
    assert [r.start for r in cast] == [-3, 12, None]
    paged = values.request_defaults(df, 5).collect()
    assert [(r.start, r.end) for r in paged] == [(0, 5), (12, 7), (0, 5)]
    assert evaluate(spark, "int", [None, 4], lambda x: values.default_if_missing(x, 0)) == [0, 4]


def test_request_id_and_timestamp(spark):
    made = spark.range(200).select(values.request_id().alias("id"), times.request_timestamp().alias("t"))
    found = made.agg(F.count_distinct("id"), F.min(F.length("id")), F.min(F.length("t"))).first()
    assert tuple(found) == (200, 36, 26)
