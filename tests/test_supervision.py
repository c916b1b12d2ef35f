"""Independent sinks: one fails, all stop, and each goes on from its own place."""

from __future__ import annotations

import pytest

from delayflow.streaming import sinks as K
from delayflow.streaming import supervision as V
from tests.test_streams import Topic, request


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path)


def appended(topic, name):
    def sink(df, checkpoint):
        return K.stream_append_mode(df, topic.path(name), checkpoint, trigger={"processingTime": "0 seconds"})

    return sink


def ids(topic, name):
    return sorted(r.UUID for r in topic.spark.read.schema("UUID string").json(topic.path(name)).collect())


def test_a_failing_sink_ends_all_and_each_resumes(topic):
    topic.send(request("1"))
    down = [True]

    def write(batch, batch_id):
        if down[0]:
            raise RuntimeError("the store is down")
        batch.write.mode("overwrite").json(f"{topic.path('store')}/batch={batch_id}")

    def store(df, checkpoint):
        return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()

    sinks = {"response": appended(topic, "response"), "store": store}
    running = V.start_sinks(topic.requests(), sinks, topic.path("c"))
    running["response"].processAllAvailable()
    with pytest.raises(V.SinkFailed, match="(?s)store.*the store is down"):
        V.supervise(running)
    assert not any(q.isActive for q in running.values())
    assert ids(topic, "response") == ["1"]

    down[0] = False
    topic.send(request("2"))
    running = V.start_sinks(topic.requests(), sinks, topic.path("c"))
    for query in running.values():
        query.processAllAvailable()
    V.stop_all(running)
    V.supervise(running)
    # The store starts with the message it failed on, the other sink behind it.
    assert ids(topic, "response") == ["1", "2"]
    assert sorted(r.UUID for r in topic.spark.read.json(topic.path("store")).collect()) == ["1", "2"]


def test_a_sink_that_cannot_start_stops_the_others(topic):
    started = []

    def first(df, checkpoint):
        started.append(appended(topic, "a")(df, checkpoint))
        return started[0]

    def broken(df, checkpoint):
        raise OSError("no such broker")

    with pytest.raises(OSError):
        V.start_sinks(topic.requests(), {"a": first, "b": broken}, topic.path("c"))
    assert not started[0].isActive
