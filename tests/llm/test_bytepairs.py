"""Byte-pair encoding against the tiktoken library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from delayflow.llm import bytepairs, queries
from tests.llm.test_text_operators import DOCS, NASTY

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return bytepairs.read_ranks(public_tokenizers.path(queries.RANKS))


@pytest.fixture(scope="module")
def known(ranks):
    return tiktoken.Encoding("known", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rng = random.Random(6)
    texts = ["", " ", "  a  b\n\n c\t", "don't we'll I'd", "12345678901234567890 3.14", "漢字かな交じり文" * 20, "😀🏳️‍🌈 é é", "<|endoftext|>"]
    texts += ["\x00\x1c\x85  　x", "a" * 5_000, "ab" * 3_000, "!?" * 700, " " * 3_000 + "x"]
    texts += ["".join(rng.choice("abcdefghijklmnop") for _ in range(n)) for n in (200, 250, 260, 900)]
    texts += ["".join(rng.choice("the ing ed and 漢é0!\n") for _ in range(300)) for _ in range(20)]
    return texts


def test_heap_gives_the_ids_of_the_library(known, ranks):
    rng = random.Random(1)
    for text in odd_texts() + ["".join(rng.choice("etaoin shrdlu") for _ in range(400)) for _ in range(50)]:
        word = text.encode()
        if word:
            assert bytepairs.heap_merges(word, ranks) == known._core_bpe.encode_single_piece(word)


def test_merges_of_many_words_are_those_of_each(ranks, known, monkeypatch):
    rng = random.Random(2)
    words = ["".join(rng.choice("etaoin shrdluabc0é漢!") for _ in range(rng.randrange(40))) for _ in range(3_000)]
    words += ["a" * 255, "ab" * 128, "x" * 257, "ab" * 400, "", "e"]
    pieces = list(ranks)
    # Ranks in any order: what is joined later may have a lesser rank, and pieces that no merges reach.
    mixed = {bytes([b]): i for i, b in enumerate(rng.sample(range(256), 256))}
    mixed |= {p: 256 + i for i, p in enumerate(rng.sample([p for p in pieces if len(p) > 1], 20_000))}
    for bound in (bytepairs.MERGED_BYTES, 100):
        monkeypatch.setattr(bytepairs, "MERGED_BYTES", bound)
        for vocabulary in (ranks, mixed, {bytes([b]): b for b in range(256)}):
            merges = bytepairs.Merges(vocabulary)
            got = merges.of_words(pa.array(words)).to_pylist()
            assert got == [bytepairs.heap_merges(w.encode(), vocabulary) for w in words]
            assert merges.of_words(pa.array([], pa.string())).to_pylist() == []
    got = bytepairs.Merges(ranks).of_words(pa.array(words)).to_pylist()
    assert got == [known._core_bpe.encode_single_piece(w.encode()) if w else [] for w in words]


def test_spark_holds_single_documents(spark, ranks):
    """Documents go to Python once, each a row without its words; no row has a whole block of them."""
    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(50)], "id int, text string")
    made = bytepairs.encode(docs, ranks, PATTERN, decoded_col="decoded", packed_col="packed")
    said = made._jdf.queryExecution().analyzed().toString()
    assert said.count("MapInArrow") == 1 and "lambda" not in said and "regexp" not in said
    grouped = bytepairs.encode(docs, ranks, f"({PATTERN})")
    assert sorted(grouped.collect()) == sorted(made.select("id", "text", "ids").collect()) and made.count() == 50


@pytest.mark.parametrize("most, block", [(0, 3_000), (40, 1 << 25), (1 << 18, 1 << 25)])
def test_ids_are_those_of_the_library(spark, known, ranks, most, block):
    said = NASTY + [(i, t, "s", 0, "h") for i, t in enumerate(odd_texts(), 10)]
    docs = spark.createDataFrame(said, DOCS).withColumnRenamed("hits", "IDS")
    made = bytepairs.encode(docs, ranks, PATTERN, most=most, block_bytes=block, decoded_col="d", packed_col="source")
    assert made.columns == [*docs.columns, "ids_", "d", "source_"]
    for r in made.collect():
        assert bytes(r.d) == (r.text or "").encode() and bytes(r.source_) == np.array(r.ids_, "<u4").tobytes()
    found = made.drop("d", "source_")
    decoded = bytepairs.decode(found, ranks, "ids_", "back", "packed")
    assert decoded.columns == [*found.columns, "back", "packed"]
    got = sorted(((*r[:5], list(r.ids_), bytes(r.back)) for r in decoded.collect()), key=str)
    expected = sorted(((*r, known.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in said), key=str)
    assert got == expected
    assert bytepairs.encode(docs.limit(0), ranks, PATTERN).count() == 0


def test_unknown_ids_decode_to_null(spark, ranks):
    ids = spark.createDataFrame([([60_000],), ([300, 5],), ([],), (None,), ([-1],), ([None, 5],)], "ids array<int>")
    back = [r.decoded for r in bytepairs.decode(ids, ranks).collect()]
    assert [b is None for b in back] == [True, False, False, True, True, True] and back[2] == b""
    with pytest.raises(ValueError):
        bytepairs.encode(ids, {b"a": 0}, PATTERN)


def test_query(spark, sf_dir, known):
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    found = queries.op12(spark, sf_dir).collect()
    assert len(found) == len(texts)
    for r in found:
        text = texts[r.doc_id] or ""
        ids = known.encode_ordinary(text)
        expected = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert tuple(r) == (r.doc_id, len(ids), expected, hashlib.sha256(text.encode()).hexdigest())


def test_words_of_every_character(spark):
    """Java and the pattern's library cut the same words around each code point that Java knows."""
    import regex

    points = spark.range(0x110000).filter("id < 55296 or id >= 57344")
    # Built from UTF-8 bytes, as Spark's own function for characters knows the first 256 only.
    texts = points.select("id", F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "utf-32").alias("c"))
    framed = texts.select("id", F.concat(F.lit("a"), "c", F.lit("1 "), "c", "c", F.lit("b  "), "c").alias("t"))
    found = framed.select("id", "t", bytepairs.words_of(F.col("t"), PATTERN).alias("w")).filter("w is not null")
    cut = regex.compile(PATTERN).findall
    rows = found.toArrow()
    assert rows.num_rows > 250_000
    wrong = [i for i, t, w in zip(*(rows[c].to_pylist() for c in ("id", "t", "w"))) if cut(t) != w]
    assert wrong == []
