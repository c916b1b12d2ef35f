"""The inverted index: scores by hand, and what a search reads."""

from __future__ import annotations

import math
import re

import pytest
from pyspark.sql import functions as F

from delayflow.operators import search as X

TEXTS = [
    ("a", "Blue Sky blue", "Acme"), ("b", "blue", "Acme Works"), ("c", "Red sky", None), ("d", None, "Other"),
    ("e", "", "acme"), ("f", "sky-blue sky", "Acme, Acme"),
]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    X.build_index(spark.createDataFrame(TEXTS, "name string, title string, maker string"), path, ["title", "maker"])
    return path


def brute(**terms):
    def cut(text):
        return re.findall(r"\w+", (text or "").lower())

    out = {}
    for name, title, maker in TEXTS:
        total = 0.0
        for field, query in terms.items():
            at = 1 if field == "title" else 2
            docs = [cut(t[at]) for t in TEXTS]
            filled = [d for d in docs if d]
            mean = sum(map(len, filled)) / len(filled)
            own = cut((name, title, maker)[at])
            shared = set(own) & set(cut(query))
            if not shared:
                break
            for word in shared:
                df = sum(word in d for d in docs)
                rarity = math.log(1 + (len(filled) - df + 0.5) / (df + 0.5))
                tf = own.count(word)
                total += rarity * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(own) / mean))
        else:
            out[name] = round(total, 6)
    return out


@pytest.mark.parametrize("terms", [{"title": "blue"}, {"title": "SKY red"}, {"title": "blue sky", "maker": "acme"}, {"maker": "none"}])
def test_scores(spark, index, terms):
    found = X.search_index(spark, index, size=10, **terms).collect()
    assert {r["name"]: r["score"] for r in found} == pytest.approx(brute(**terms), abs=2e-6)
    scores = [r["score"] for r in found]
    assert scores == sorted(scores, reverse=True) and X.search_hits(spark, index, **terms) == len(found)
    paged = [r for i in range(3) for r in X.search_index(spark, index, start=2 * i, size=2, **terms).collect()]
    assert paged == found[:6]


def test_odd_queries(spark, index):
    assert X.search_index(spark, index, title="!?").collect() == [] and X.search_hits(spark, index, title="!?") == 0
    assert X.search_index(spark, index, title=None, size=10).count() == len(TEXTS)
    with pytest.raises(ValueError):
        X.search_index(spark, index, title=" ".join(f"w{i}" for i in range(300)))


def test_a_search_reads_the_postings_of_its_words_only(spark, tmp_path):
    path = str(tmp_path / "index")
    rows = spark.range(40_000).select(
        F.concat(F.lit("common w"), F.col("id").cast("string")).alias("title"), F.col("id").cast("string").alias("name")
    )
    X.build_index(rows, path, ["title"])
    postings = spark.read.parquet(f"{path}/postings")
    wanted = postings.filter(F.col("word").isin(["w777"]) & (F.col("field") == "title"))
    assert len(wanted.collect()) == 1
    plan = wanted._jdf.queryExecution().executedPlan()
    read = plan.collectLeaves().head().metrics().apply("numOutputRows").value()
    assert read < postings.count() / 2
    assert [r["name"] for r in X.search_index(spark, path, title="w777").collect()] == ["777"]
    assert X.search_hits(spark, path, title="common") == 40_000
