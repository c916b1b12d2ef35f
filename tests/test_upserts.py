"""Upserts into a bucketed table: cost of a batch, replay, reads without history."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from delayflow.streaming import upserts as U
from delayflow.workspace import folders
from tests.conftest import rows


def batch_of(spark, items):
    return spark.createDataFrame(items, "k string, stamp int, v string")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_batches_cost_the_buckets_they_touch_and_reads_no_history(spark, tmp_path):
    path, rng, known = str(tmp_path / "t"), random.Random(1), {}
    for number in range(7):
        items = [(f"k{rng.randrange(30)}", number, f"v{number}-{i}") for i in range(3)]
        touched = U.upsert(batch_of(spark, items), path, "k", ["stamp"], "q", number, buckets=8)
        by_hand = {r[0] for r in batch_of(spark, items).select(U.bucket_of(F.col("k"), 8)).collect()}
        assert set(touched) == by_hand and len(touched) <= 3
        for k, stamp, v in items:
            known[k] = max(known.get(k, (0, "")), (stamp, v))
    state = U.read_upserts(spark, path)
    assert rows(state) == sorted(((k, *x) for k, x in known.items()), key=str)
    assert "Exchange" not in plan(state) and "Aggregate" not in plan(state)
    one = U.lookup_upsert(spark, path, "k", "k8")
    assert rows(one) == [("k8", *known["k8"])] and len(one.inputFiles()) == 1
    # At most two copies of each bucket are kept, however many batches there were.
    target = U.Target(spark, path)
    assert all(len(held) <= 2 for held in target.versions(target.commits()).values())
    assert len(folders(spark, target.root(8))) <= 17


def test_a_batch_run_again_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    first = batch_of(spark, [("a", 1, "old"), ("b", 1, "old")])
    assert U.upsert(first, path, "k", ["stamp"], "q", 0, buckets=4)
    later = batch_of(spark, [("a", 2, "new")])
    assert U.upsert(later, path, "k", ["stamp"], "q", 1, buckets=4)
    assert U.upsert(later, path, "k", ["stamp"], "q", 1, buckets=4) == []
    assert rows(U.read_upserts(spark, path)) == [("a", 2, "new"), ("b", 1, "old")]
    with pytest.raises(ValueError):
        U.upsert(later, path, "k", ["stamp"], "q", 2, buckets=5)


def test_a_write_that_did_not_end_is_not_read_and_is_written_again(spark, tmp_path):
    path = str(tmp_path / "t")
    U.upsert(batch_of(spark, [("a", 1, "old")]), path, "k", ["stamp"], "q", 0, buckets=4)
    half = U.Commit(2, "q", 1)
    broken = f"{U.Target(spark, path).root(4)}/{half.name}"
    batch_of(spark, [("a", 9, "half")]).withColumn(U.BUCKET, U.bucket_of(F.col("k"), 4)).write.partitionBy(U.BUCKET).parquet(broken)
    (tmp_path / "t" / "buckets=4" / half.name / "_SUCCESS").unlink()
    assert rows(U.read_upserts(spark, path)) == [("a", 1, "old")]
    U.upsert(batch_of(spark, [("a", 2, "new")]), path, "k", ["stamp"], "q", 1, buckets=4)
    assert rows(U.read_upserts(spark, path)) == [("a", 2, "new")]


def test_order_beats_arrival_and_arrival_breaks_ties(spark, tmp_path):
    path = str(tmp_path / "t")
    for number, (stamp, v) in enumerate([(5, "first"), (3, "stale"), (5, "again")]):
        U.upsert(batch_of(spark, [("a", stamp, v)]), path, "k", ["stamp"], f"q{number}", 0, buckets=2)
        expected = "again" if number == 2 else "first"
        assert rows(U.read_upserts(spark, path)) == [("a", 5, expected)]


def test_rows_without_a_key_are_kept_beside_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    items = [(None, 1, "x"), (None, 2, "y"), ("k", 1, "z")]
    for _ in range(2):
        U.upsert(batch_of(spark, items), path, "k", ["stamp"], "q", 0, buckets=2)
    U.upsert(batch_of(spark, [(None, 3, "w")]), path, "k", ["stamp"], "q", 1, buckets=2)
    assert rows(U.read_upserts(spark, path)) == [("k", 1, "z")]
    assert sorted(r.v for r in spark.read.parquet(path + U.UNKEYED).collect()) == ["w", "x", "y"]


def test_nothing_written_yet(spark, tmp_path):
    path = str(tmp_path / "t")
    assert U.upsert(batch_of(spark, []), path, "k", ["stamp"], "q", 0) == []
    assert U.lookup_upsert(spark, path, "k", "a") is None
    with pytest.raises(FileNotFoundError):
        U.read_upserts(spark, path)
