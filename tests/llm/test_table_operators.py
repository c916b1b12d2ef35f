"""Quality rules, pseudonyms, archives, dialogues and the pipeline."""

from __future__ import annotations

import base64
import datetime
import gzip
import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from delayflow.llm import archives, decontamination, dialogues, pseudonyms, queries, rules, simhash
from delayflow.workspace import new_path
from tests.llm.test_text_operators import DOCS, NASTY

PYTHON_NODES = ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoopJoin")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_sql_twins(spark, sf_dir, key):
    duck = duckdb.connect()
    for name in "documents pages benchmark labels conversations".split():
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    expected = duck.execute(queries.ORACLES[key]).fetchall()
    names = [d[0] for d in duck.description]
    found = queries.QUERIES[key](spark, sf_dir)
    assert sorted(found.columns) == sorted(names)
    assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in found.select(names).collect())


def brute_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    inside = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)), len(inside),
    )


def test_statistics(spark, sf_dir):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    texts += [(-1, None), (-2, ""), (-3, "a a a a a b"), (-4, "x\n\ny\nx\r\n x 😀| a b a b a b\x0b"), (-5, "a b c a b"), (-6, "a b")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = rules.with_statistics(docs).collect()
    assert len(found) == len(texts)
    for r in found:
        assert tuple(r["_stats"])[:5] == brute_statistics(r.row.text), r.row.doc_id


def test_rules_find_the_cause(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(i, good + (" ".join(f" #{k}" for k in range(20)) if i % 4 == 0 else f" {i}"), "x", "y") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _stats string, quality string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(400)], "doc_id long, quality int, toxic int")
    judged, learned = rules.judge(docs, labels)
    assert [c.feature for c in learned[0]][:1] == ["symbols"]
    assert {r.row.doc_id % 4 for r in judged.filter("_kept").collect()} == {1, 2, 3}
    assert rules.keep_good(docs, labels).columns == docs.columns
    assert not any(n in plan(judged) for n in PYTHON_NODES)


def test_rules_odd_rows(spark):
    nasty = spark.createDataFrame(NASTY, DOCS)
    labels = spark.createDataFrame([(1, 0), (None, 1), (2, None), (3, 1), (3, 0)], "doc_id long, quality int")
    judged, learned = rules.judge(nasty, labels)
    assert judged.count() == len(NASTY) and learned == []
    assert rules.judge(nasty.limit(0), labels.limit(0))[0].count() == 0


def test_rules_query(spark, sf_dir):
    found = queries.op3(spark, sf_dir)
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    for r in found.collect():
        n, _, _, _, repeated = brute_statistics(texts[r.doc_id])
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n)
        assert r.kept == (not r.base_failed and r.rule is None)
    assert not any(n in plan(found) for n in PYTHON_NODES)


KEY = "k"


def brute_permute(value, tweak, alphabets=pseudonyms.ALPHABETS):
    cut = len(value) // 2
    halves = [value[:cut], value[cut:]]
    for i in range(pseudonyms.ROUNDS):
        digest = hashlib.sha256(f"{KEY}|{tweak}|{i}|{halves[1 - i % 2]}".encode()).hexdigest()
        out = ""
        for j, c in enumerate(halves[i % 2]):
            step = int(digest[2 * (j % 32) : 2 * (j % 32) + 2], 16)
            for a in alphabets:
                if c in a:
                    c = a[(a.index(c) + step) % len(a)]
                    break
            out += c
        halves[i % 2] = out
    return "".join(halves)


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def iban_ok(value):
    value = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def test_pseudonyms(spark):
    card = next(f"41111111{i:08d}" for i in range(100) if luhn(f"41111111{i:08d}"))
    cases = {
        "mail": "write jane.doe7@mail3.example.com now", "same": "x jane.doe7@mail3.example.com", "card": f"pay {card}!!",
        "spaced": f"pay {card[:4]} {card[4:8]} {card[8:12]} {card[12:]}.", "bad card": f"pay {int(card) + 1} now",
        "iban": "to GB82 WEST 1234 5698 7654 32.", "bad iban": "to GB83 WEST 1234 5698 7654 32.",
        "ip": "from 10.0.0.255 on", "bad ip": "from 10.0.0.256 on", "phone": "call +1 (017) 555-7713 or (020) 555 1234",
        "day": "born 2000-02-29, 31.12.1999 and 12/31/1999", "bad day": "born 2001-02-29 or 31.02.1999",
        "ssn": "no 123-45-6789", "secret": 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"',
        "none": "version 2.0, 4.0 and 1234 of 04dbebab91ab85687d33eeaaf9ac699e1188f962", "null": None, "empty": "",
        "two": f"{card}a@b.example {card} {card}", "long": "word 7 " * 30_000 + "a.b@c.example",
    }
    docs = spark.createDataFrame([(k, v, "z") for k, v in cases.items()], "doc_id string, text string, _found string")
    frame = pseudonyms.pseudonymise(docs, key=KEY, found_col="kinds")
    assert not any(n in plan(frame) for n in PYTHON_NODES)
    found = {r.doc_id: r for r in frame.collect()}
    text = {k: r.text for k, r in found.items()}
    for same in ("bad card", "bad iban", "bad ip", "bad day", "none", "null", "empty"):
        assert text[same] == cases[same] and not found[same].kinds
    local = brute_permute("jane.doe7@mail3.example", "email")
    assert text["mail"] == f"write {local}.com now" and text["same"] == f"x {local}.com"
    new = re.search(r"\d{16}", text["card"])[0]
    assert new[:15] == brute_permute(card[:15], "card16") and luhn(new) and text["card"] == f"pay {new}!!"
    assert text["spaced"] == f"pay {new[:4]} {new[4:8]} {new[8:12]} {new[12:]}."
    assert iban_ok(text["iban"][3:-1]) and re.fullmatch(r"to GB\d\d [A-Z]{4}( \d{4}){3} \d\d\.", text["iban"])
    assert text["iban"] != cases["iban"]
    octets = re.fullmatch(r"from (\d+)\.(\d+)\.(\d+)\.(\d+) on", text["ip"]).groups()
    assert all(int(o) <= 255 for o in octets) and text["ip"] != cases["ip"]
    assert text["phone"].startswith("call +1 (") and re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4} or \(\d{3}\) \d{3} \d{4}", text["phone"])
    a, b, c = re.fullmatch(r"born (\S+), (\S+) and (\S+)", text["day"]).groups()
    days = [datetime.datetime.strptime(a, "%Y-%m-%d"), datetime.datetime.strptime(b, "%d.%m.%Y"), datetime.datetime.strptime(c, "%m/%d/%Y")]
    assert datetime.datetime(2000, 2, 29) not in days
    assert text["ssn"] == "no " + brute_permute("123-45-6789", "ssn")
    assert text["secret"] == f'token = "{brute_permute("04dbebab91ab85687d33eeaaf9ac699e1188f962", "secret", pseudonyms.HEX)}"'
    assert text["two"].endswith(f" {new} {new}") and text["long"].startswith("word 7 word 7 ")
    assert [found[k].kinds for k in ("mail", "day", "secret")] == [["email"], ["ymd", "dmy", "mdy"], ["secret"]]


def test_permutations_lose_nothing(spark):
    numbers = spark.range(189 * 773).select("id", pseudonyms.permute_number(F.col("id"), 189, 773, KEY, "t").alias("p"))
    row = numbers.agg(F.count_distinct("p").alias("n"), F.min("p").alias("low"), F.max("p").alias("high")).first()
    assert (row.n, row.low, row.high) == (189 * 773, 0, 189 * 773 - 1)
    words = spark.range(10_000).select(pseudonyms.permute(F.lpad(F.col("id").cast("string"), 4, "0"), KEY, "t").alias("p"))
    assert words.distinct().count() == 10_000


def test_pseudonyms_odd_rows(spark):
    nasty = spark.createDataFrame(NASTY, DOCS)
    assert sorted(map(str, pseudonyms.pseudonymise(nasty).collect())) == sorted(map(str, nasty.collect()))
    assert pseudonyms.pseudonymise(nasty.limit(0)).count() == 0


def b32(payload):
    return base64.b32encode(hashlib.sha1(payload.encode()).digest()).decode()


def test_archives_round_trip(spark):
    tricky = "<p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nContent-Length: 3\r\n\r\né"
    rows = [(5, "http://a/x y", tricky, 1), (3, "http://b/", tricky, 1), (9, None, None, 1), (8, "u", "", 1), (None, "u", "n", 1), (7, "u", "n", 1), (7, "u", "n", 1)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, record_type int")
    path = new_path(spark, "warc")
    archives.write_captures(table, path, captures_per_file=2)
    found = archives.assemble(archives.read_records(spark, path)).collect()
    assert len(found) == len(rows)
    def page(urn):
        return urn and urn.split("/")[0][12:]

    kinds = sorted((page(r.capture.record_id), r.capture.record_type, page(r.capture.refers_to), r.capture.payload_bytes) for r in found)
    size = len(tricky.encode())
    assert kinds == sorted([
        ("5", "revisit", "3", size), ("3", "response", None, size), ("9", "revisit", "8", 0),
        ("8", "response", None, 0), ("", "revisit", "7", 1), ("7", "response", None, 1), ("7", "response", None, 1)])
    # A reference is the id of a response in the archive, unless several rows are that response.
    ids = {r.capture.record_id: r.capture.record_type for r in found}
    assert len(ids) == len(found)
    for r in found:
        assert r.capture.record_type == "response" or page(r.capture.refers_to) == "7" or ids[r.capture.refers_to] == "response"
    for r in found:
        assert [x.record_type for x in (*r.requests, *r.metadata)] == ["request", "metadata"]
        assert r.requests[0].concurrent_to == [r.capture.record_id]
        if r.capture.record_id.startswith(("<urn:x-page:3/", "<urn:x-page:5/")):
            assert r.capture.payload_digest == b32(tricky)
        if r.capture.record_id.startswith("<urn:x-page:3/"):
            assert r.capture.payload.decode() == tricky
    path = new_path(spark, "warc")
    archives.write_captures(table, path, min_bytes=2)
    again = archives.read_records(spark, path, keep_payload=False).filter("record_type = 'revisit'").collect()
    assert [page(r.refers_to) for r in again] == ["3"]
    path = new_path(spark, "warc")
    archives.write_captures(table.limit(0), path)
    assert archives.assemble(archives.read_records(spark, path)).count() == 0


def test_transactions_of_other_writers(spark):
    def record(kind, name, to=(), body=b"x"):
        lines = [b"WARC/1.0", b"WARC-Type: " + kind, b"WARC-Record-ID: <" + name + b">"]
        lines += [b"WARC-Concurrent-To: <" + t + b">" for t in to] + [b"Content-Length: %d" % len(body)]
        return b"\r\n".join(lines) + b"\r\n\r\n" + body + b"\r\n\r\n"

    data = record(b"warcinfo", b"i") + record(b"response", b"r", [b"q"]) + record(b"request", b"q")
    data += b"".join(record(b"metadata", b"m%d" % i, [b"r"]) for i in range(25)) + record(b"metadata", b"lost", [b"?"])
    each = b"".join(gzip.compress(x) for x in (data[:40], data[40:]))
    assert list(archives.parse_records(each)) == list(archives.parse_records(data))
    assert len(list(archives.parse_records(data[:-6]))) == 28
    frame = spark.createDataFrame(list(archives.parse_records(data)), archives.RECORD)
    whole = archives.assemble(frame).collect()
    assert len(whole) == 1 and len(whole[0].metadata) == 25 and len(whole[0].requests) == 1
    parts = archives.assemble(frame, companions=10).collect()
    assert len(parts) == 3 and sum(len(p.metadata) for p in parts) == 25 and {p.capture.record_id for p in parts} == {"<r>"}


def test_dialogues(spark):
    said = [
        (1, 0, "system", "Be kind.", 0), (1, 1, "ann", "Hi", 0), (1, 2, "bob", "Hello", 0), (1, 3, "ann", None, 0), (1, 3, "ann", None, 0),
        (2, 0, "system", "alone", 0), (None, None, None, "who", 0), (3, 0, "ann", "", 0),
    ]
    table = spark.createDataFrame(said, "conv_id long, turn long, role string, text string, part int")
    frame = dialogues.perspectives(table)
    assert not any(n in plan(frame) for n in PYTHON_NODES)
    found = {(r.conv_id, r.perspective): r for r in frame.collect()}
    assert set(found) == {(1, "ann"), (1, "bob"), (None, "unknown"), (3, "ann")}
    bob = found[1, "bob"]
    assert bob.text.startswith("<|system|>\nBe kind.\n<|end|>\n<|user name=ann|>\nHi\n<|end|>\n<|assistant|>\nHello\n<|end|>\n")
    assert [bob.text[s.start : s.end] for s in bob.mask] == ["Hello\n<|end|>\n"]
    ann = found[1, "ann"]
    assert ann.n_messages == 5 and [ann.text[s.start : s.end] for s in ann.mask] == ["Hi\n<|end|>\n", "\n<|end|>\n", "\n<|end|>\n"]
    long = spark.range(50).select(F.lit(1).alias("conv_id"), F.lit(0).alias("turn"), F.concat(F.lit("s"), F.col("id") % 3).alias("role"), F.col("id").cast("string").alias("text"))
    cut = dialogues.perspectives(long, size=8).collect()
    assert len(cut) == 21 and max(r.n_messages for r in cut) == 8
    for name in ("s0", "s1", "s2"):
        own = sorted((r for r in cut if r.perspective == name), key=lambda r: r.part)
        assert [r.first for r in own] == [8 * i for i in range(7)]
        assert len({m.content for r in own for m in r.messages}) == 50
    assert dialogues.perspectives(table.limit(0)).count() == 0


def test_pipeline_against_brute_force(spark, sf_dir):
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs, kept = source, []
    for name, stage in corpus_pipeline.STAGES:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        kept.append(docs)
    assert [len(k.columns) for k in kept[:4]] == [5] * 4
    texts = dict(source.select("doc_id", "text").collect())
    first = {r.doc_id for r in kept[0].collect()}
    assert first == {r.doc_id for r in queries.op3(spark, sf_dir).filter("kept").collect()}
    prints = {d: simhash.fingerprint(texts[d]) for d in first}
    second, reached = set(), set()
    for d in sorted(first):
        if d in reached:
            continue
        second.add(d)
        todo = [d]
        while todo:
            one = todo.pop()
            near = {x for x in first - reached if (prints[x] ^ prints[one]).bit_count() <= 2}
            reached |= near
            todo += near - {one}
    assert {r.doc_id for r in kept[1].collect()} == second
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    windows = decontamination.WindowSet([(str(i), t) for i, t in bench], 10)
    third = {d for d in second if not windows.hits(decontamination.fold_words(texts[d]))[0]}
    assert {r.doc_id for r in kept[2].collect()} == third
    assert {r.doc_id for r in kept[3].collect()} == third
    for r in kept[3].collect():
        assert not re.search(r"@mail\d", r.text) or r.text != texts[r.doc_id]
    packed = kept[4].groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert {r.doc_id for r in kept[4].collect()} == third and max(p.n for p in packed) <= 2048
    assert corpus_pipeline.run(spark, sf_dir).count() == kept[4].count()
