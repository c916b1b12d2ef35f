"""Bounded streams: restart, fan-out, upsert and correlation."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from delayflow.registry import streams as registered
from delayflow.registry.streams import finish
from delayflow.session import state_session
from delayflow.streaming import sinks as K
from delayflow.streaming import sources as S
from delayflow.streaming import transforms as X
from delayflow.streaming import upserts as U
from tests.conftest import rows


class Topic:
    """A folder of messages, and where results go."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.input = folder / "in"
        self.input.mkdir()
        self.files = 0

    def send(self, *records):
        self.files += 1
        lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
        (self.input / f"m{self.files}.txt").write_text("\n".join(lines) + "\n")

    def requests(self):
        return X.stream_parse_requests(S.stream_earliest(self.spark, str(self.input)))

    def path(self, name):
        return str(self.folder / name)


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path)


def request(uuid, **more):
    return {"UUID": uuid, "Origin": "A", "Dest": "B", "Timestamp": "2024-01-01T00:00:00", **more}


def with_class(df, prediction=1.0):
    return df.withColumn("Prediction", F.lit(prediction))


def test_malformed_messages_become_null_rows(topic):
    topic.send(request("1", DepDelay="late", DayOfWeek=3), "no json")
    out = topic.path("out")
    finish(K.stream_append_mode(topic.requests(), out, topic.path("c"), trigger=K.DRAIN))
    found = topic.spark.read.schema("UUID string, DayOfWeek int, DepDelay double").json(out)
    assert rows(found) == [("1", 3, None), (None, None, None)]


def test_restart_takes_only_new_messages(topic):
    out = topic.path("out")
    for batch in (["1", "2"], ["3"], []):
        if batch:
            topic.send(*[request(u) for u in batch])
        finish(K.stream_checkpoint_resume(topic.requests(), out, topic.path("c")))
    assert [r.UUID for r in topic.spark.read.json(out).orderBy("UUID").collect()] == ["1", "2", "3"]


def test_fanout_writes_each_sink_once_per_batch(topic):
    computed = []
    def count(batch, batch_id):
        computed.append((batch_id, batch.count()))
    writers = [K.response_writer(topic.path("a")), K.response_writer(topic.path("b")), count, K.debug_writer()]
    for uuid in ("1", "2"):
        topic.send(request(uuid))
        finish(K.stream_fanout(with_class(topic.requests()), writers, topic.path("c"), K.DRAIN))
    assert computed == [(0, 1), (1, 1)]
    for name in ("a", "b"):
        values = topic.spark.read.text(topic.path(name))
        assert sorted(json.loads(r.value)["UUID"] for r in values.collect()) == ["1", "2"]


def test_incomplete_rows_go_to_the_rejects(topic):
    topic.send(request("1", DepDelay=1.0), request("2"), "no json")
    good, bad = topic.path("good"), topic.path("bad")
    running = K.stream_fanout(
        topic.requests(), [K.response_writer(good)], topic.path("c"), K.DRAIN,
        rejects=K.response_writer(bad), required=["UUID", "DepDelay"],
    )
    finish(running)
    found = {n: sorted(r.value for r in topic.spark.read.text(n).collect()) for n in (good, bad)}
    assert [json.loads(v)["UUID"] for v in found[good]] == ["1"]
    assert [json.loads(v).get("UUID") for v in found[bad]] == ["2", None]


def test_failure_of_a_sink_stops_the_query_and_replay_adds_nothing(topic):
    topic.send(request("1"), request("2"))
    def fail(batch, batch_id):
        raise RuntimeError("sink is down")
    store = K.response_writer(topic.path("a"))
    with pytest.raises(Exception, match="sink is down"):
        finish(K.stream_fanout(topic.requests(), [store, fail], topic.path("c"), K.DRAIN))
    assert topic.spark.read.text(topic.path("a")).count() == 2
    finish(K.stream_fanout(topic.requests(), [store], topic.path("c"), K.DRAIN))
    assert topic.spark.read.text(topic.path("a")).count() == 2


def test_upsert_keeps_the_last_write(topic):
    out = topic.path("store")
    for prediction in (1.0, 3.0):
        topic.send(request("1"), request("2" if prediction == 1.0 else "3"))
        rows_in = with_class(topic.requests(), prediction)
        finish(U.stream_sink_keyed_upsert(rows_in, out, topic.path("c"), K.DRAIN))
    state = U.read_upserts(topic.spark, out)
    expected = [("1", "A", "B", 3), ("2", "A", "B", 1), ("3", "A", "B", 3)]
    assert rows(state.drop("timestamp")) == expected
    assert rows(U.lookup_upsert(topic.spark, out, "uuid", "2").drop("timestamp")) == [("2", "A", "B", 1)]


def test_upsert_order_within_a_batch(topic):
    topic.send(
        request("1", Timestamp="2024-01-01T00:00:09", DepDelay=2.0),
        request("1", Timestamp="2024-01-01T00:00:05", DepDelay=1.0),
    )
    kept = topic.requests().select("UUID", "Timestamp", "DepDelay")
    finish(U.stream_upsert_latest(kept, topic.path("s"), "UUID", ["Timestamp"], topic.path("c"), K.DRAIN))
    assert U.read_upserts(topic.spark, topic.path("s")).first()["DepDelay"] == 2.0


def test_empty_batches_are_not_written(topic):
    topic.send(request("1"))
    written = []
    def write(batch, batch_id):
        written.append(batch_id)
    nothing = topic.requests().filter("UUID = 'none'")
    finish(K.stream_skip_empty_batch(nothing, write, topic.path("c1"), K.DRAIN))
    assert written == []
    finish(K.stream_skip_empty_batch(topic.requests(), write, topic.path("c2"), K.DRAIN))
    assert written == [0]


def test_distance_is_added_on_the_stream(topic):
    dim = topic.spark.createDataFrame([("A", "B", 7.0)], "Origin string, Dest string, Distance double")
    topic.send(request("1", FlightDate="2016-12-25"), request("2", Dest="Z", FlightDate="2016-12-26"))
    raw = topic.requests().drop("Distance", "DayOfYear", "DayOfMonth", "DayOfWeek")
    full = X.stream_enrich_distance(raw, dim)
    finish(K.stream_append_mode(full, topic.path("o"), topic.path("c"), trigger=K.DRAIN))
    found = topic.spark.read.json(topic.path("o")).select("UUID", "Distance", "DayOfYear", "DayOfWeek")
    assert rows(found) == [("1", 7.0, 360, 7), ("2", 0.0, 361, 1)]


def test_correlation_takes_the_first_response_in_time(topic):
    clock = "2024-01-01T00:{:02d}:00"
    topic.send(
        request("answered"), request("late"), request("silent"), "no json", "nor this",
        request("stray", Timestamp=clock.format(5)), request("twice"), request("twice"),
        request("last", Timestamp=clock.format(59)),
    )
    responses = topic.folder / "responses"
    responses.mkdir()
    lines = [
        {"UUID": "answered", "Timestamp": clock.format(2), "Prediction": 1.0},
        {"UUID": "late", "Timestamp": clock.format(30), "Prediction": 3.0},
        {"UUID": "stray", "Timestamp": clock.format(4), "Prediction": 9.0},
        {"UUID": "stray", "Timestamp": clock.format(7), "Prediction": 2.0},
        {"UUID": "stray", "Timestamp": clock.format(6), "Prediction": 3.0},
        {"UUID": "twice", "Timestamp": clock.format(1), "Prediction": 1.0},
        {"UUID": "twice", "Timestamp": clock.format(1), "Prediction": 2.0},
        {"UUID": "other", "Timestamp": clock.format(58), "Prediction": 0.0},
        {"UUID": "last", "Timestamp": clock.format(59), "Prediction": 0.0},
    ]
    (responses / "r.json").write_text("\n".join(map(json.dumps, lines)))
    arriving = topic.spark.readStream.schema("UUID string, Timestamp timestamp, Prediction double").json(str(responses))
    pairs = X.stream_correlate(topic.requests(), arriving).select("UUID", "status", "Prediction")
    finish(K.stream_append_mode(pairs, topic.path("o"), topic.path("c"), trigger=K.DRAIN))
    found = topic.spark.read.schema("UUID string, status string, Prediction double").json(topic.path("o"))
    assert rows(found) == [
        ("answered", "OK", 1.0), ("late", "WAIT", None), ("silent", "WAIT", None), ("stray", "OK", 3.0),
        ("twice", "OK", 1.0), ("twice", "OK", 1.0), (None, "WAIT", None), (None, "WAIT", None),
    ]


def test_state_is_logged_and_not_counted(topic):
    session = state_session(topic.spark, 2)
    topic.send(request("1"), request("2"), request("last", Timestamp="2024-01-01T01:00:00"))
    answers = topic.folder / "answers"
    answers.mkdir()
    said = [{"UUID": "1", "Timestamp": "2024-01-01T00:01:00"}, {"UUID": "-", "Timestamp": "2024-01-01T01:00:00"}]
    (answers / "a.json").write_text("\n".join(map(json.dumps, said)))
    arriving = session.readStream.schema("UUID string, Timestamp timestamp").json(str(answers))
    requests = X.stream_parse_requests(S.stream_earliest(session, str(topic.input)))
    pairs = X.stream_correlate(requests, arriving).select("UUID", "status")
    running = finish(K.stream_append_mode(pairs, topic.path("o"), topic.path("c"), trigger=K.DRAIN))
    assert rows(topic.spark.read.json(topic.path("o"))) == [("1", "OK"), ("2", "WAIT")]
    # Batches leave their changes in the checkpoint instead of copies of all state.
    assert list((topic.folder / "c" / "state").rglob("1.changelog"))
    assert not list((topic.folder / "c" / "state").rglob("*.zip"))
    counted = [o["numRowsTotal"] for p in running.recentProgress for o in p["stateOperators"]]
    assert counted and not any(counted)


def test_requests_of_the_fixture_are_all_parsed(spark, sf_dir):
    folder = registered.request_lines(spark, sf_dir)
    assert spark.read.text(folder).count() == spark.read.parquet(f"{sf_dir}/events.parquet").count()


def test_late_requests_are_settled_afterwards(spark):
    stamp = F.col("Timestamp").cast("timestamp")
    asked = spark.createDataFrame(
        [("a", "2024-01-01 00:00:00"), ("late", "2024-01-01 00:01:00"), ("open", "2024-01-01 00:02:00")],
        "UUID string, Timestamp string",
    ).withColumn("Timestamp", stamp)
    said = spark.createDataFrame(
        [("late", "2024-01-01 00:05:00", 2.0), ("late", "2024-01-01 00:03:00", 1.0), ("open", "2024-01-01 09:00:00", 1.0)],
        "UUID string, Timestamp string, Prediction double",
    ).withColumn("Timestamp", stamp)
    # Of two equal requests one was given out.
    asked = asked.union(asked.filter("UUID IN ('a', 'late')"))
    given = asked.filter("UUID = 'a'").limit(1).withColumn("status", F.lit("WAIT"))
    found = X.close_correlation(asked, said, given).select("UUID", "Prediction", "status").collect()
    assert sorted(map(tuple, found)) == [("a", None, "WAIT"), ("late", 1.0, "OK"), ("late", 1.0, "OK"), ("open", None, "WAIT")]


def test_a_rate_limit_parts_a_backlog_and_leaves_nothing_out(topic):
    for number in range(5):
        topic.send(request(str(number)))
    options = {"path": str(topic.input), "maxFilesPerTrigger": 2}
    assert S.with_rate_limit("text", options) == options
    assert S.with_rate_limit("text", {"path": "p"})["maxFilesPerTrigger"] == 1_000
    assert "maxOffsetsPerTrigger" in S.with_rate_limit("kafka", {"subscribe": "t"})
    messages = S.stream_source_requests(topic.spark, "text", S.with_rate_limit("text", options))
    shown = topic.path("shown")
    running = K.stream_sink_debug(
        X.stream_parse_requests(messages), topic.path("c"), "json", K.DRAIN, {"path": shown}
    )
    finish(running)
    assert [p["numInputRows"] for p in running.recentProgress if p["numInputRows"]] == [2, 2, 1]
    assert sorted(r["UUID"] for r in topic.spark.read.json(shown).collect()) == list("01234")


def test_every_message_is_good_or_a_dead_letter(topic):
    odd = ["", "   ", "[1]", '"text"', "7", "{", '{"UUID": "x", "DepDelay": "late"}', '{"UUID": "y", "Timestamp": "never"}', "null"]
    topic.send(request("1", DepDelay=1.5), "{}", {"UUID": "2", "more": 1}, *odd)
    messages = S.stream_earliest(topic.spark, str(topic.input))
    good, dead = topic.path("good"), topic.path("dead")
    rows_in = X.stream_parse_or_dead(messages)
    finish(K.stream_route(rows_in, [K.table_writer(good)], K.table_writer(dead), topic.path("c"), K.DRAIN))
    assert rows(topic.spark.read.parquet(good).select("UUID", "DepDelay")) == [("1", 1.5), ("2", None), (None, None)]
    assert sorted(r.raw for r in topic.spark.read.parquet(dead).select("raw").collect()) == sorted(odd)
    batch = S.stream_earliest(topic.spark, str(topic.input)).isStreaming
    whole = topic.spark.createDataFrame([(None,), ("{}",)], "value string")
    assert batch and [r.dead is None for r in X.stream_parse_or_dead(whole).collect()] == [False, True]
