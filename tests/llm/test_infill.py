"""Fill-in-middle against brute force: units by a pattern, cuts and outputs by slices."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from delayflow.llm import infill, queries
from tests.llm.test_text_operators import DOCS, NASTY

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text, infill_percent=50):
    text = text or ""
    units = UNITS.findall(text)
    digits = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= infill_percent:
        return len(units), "plain", None, None, text
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("least, largest, bits", [(256, 16_384, 11), (3, 9, 2)])
def test_units_of_combined_chunks(monkeypatch, least, largest, bits):
    for name, value in (("LEAST_CHUNK", least), ("LARGEST_CHUNK", largest), ("CUT_BITS", bits), ("HASH_BLOCK", 40)):
        monkeypatch.setattr(infill, name, value)
    rng, cache = random.Random(1), infill.Summaries(1_000)
    for _ in range(500):
        text = "".join(rng.choice(" \t\nabé漢x \r\x1c") for _ in range(rng.randrange(0, 90)))
        units, words = infill.Units(text.encode(), cache), UNITS.findall(text)
        assert units.count == len(words)
        for k in range(len(words) + 1):
            head = "".join(words[:k])
            assert units.cut(k) == (len(head.encode()), len(head))


def test_hashes_look_back_one_window_in_any_blocks(monkeypatch):
    data = np.frombuffer(random.Random(3).randbytes(5_000), np.uint8)
    whole = infill.rolling_hashes(data)
    assert (infill.rolling_hashes(data[1_000:])[infill.WINDOW :] == whole[1_000 + infill.WINDOW :]).all()
    edges = infill.chunk_edges(data)
    monkeypatch.setattr(infill, "HASH_BLOCK", 77)
    assert infill.chunk_edges(data) == edges


def test_shared_passages_are_summarised_once():
    rng = random.Random(9)
    passage = " ".join(f"w{rng.randrange(9_999)}" for _ in range(20_000)).encode()
    cache = infill.Summaries()
    for i in range(5):
        infill.Units(b"own beginning %d " % i * (i + 3) + passage, cache)
    assert cache.known > 0.75 * cache.asked


@pytest.mark.parametrize("percent", [50, 100])
def test_rows(spark, percent):
    rng = random.Random(2)
    said = NASTY + [(i, "".join(rng.choice("ab é\n\t<PSM>") for _ in range(rng.randrange(60))), "s", 0, "h") for i in range(9, 150)]
    said += [(7, "a <M> b", "s", 0, "h"), (8, " \n", "s", 0, "h"), (8, "<<S<P", "s", 0, "h")]
    docs = spark.createDataFrame(said, DOCS).withColumnRenamed("hits", "Infill")
    found = infill.fill_in_middle(docs, infill_percent=percent)
    assert found.columns == [*docs.columns, "infill_"]
    back = infill.restore(F.col("infill_.output"), F.col("infill_.form"))
    got = sorted((tuple(r) for r in found.withColumn("back", back).collect()), key=str)
    expected = sorted(((*r[:4], r[4], brute(r[0], r[1], percent), r[1] or "") for r in said), key=str)
    assert got == expected
    assert infill.fill_in_middle(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        infill.fill_in_middle(docs, marks=("<P>", "<P>", "<M>"))


def test_query(spark, sf_dir):
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    for r in queries.op11(spark, sf_dir).collect():
        *known, output = brute(r.doc_id, texts[r.doc_id])
        assert tuple(r) == (r.doc_id, *known, digest(output), digest(texts[r.doc_id]))
