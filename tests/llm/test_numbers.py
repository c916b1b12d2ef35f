"""Card and account numbers beside other numbers and words."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from delayflow.llm import pseudonyms
from tests.llm.test_table_operators import KEY, PYTHON_NODES, iban_ok, luhn, plan

CARD, DASHED = "4111 1111 1111 1111", "4111-1111-1111-1111"
AT, ES = "AT61 1904 3002 3457 3201", "ES91 2100 0418 4502 0005 1332"


def test_neighbours_do_not_hide_numbers(spark):
    cases = {
        "expiry": (f"Card {CARD} 12/26", [CARD]), "cvv": (f"Card {CARD} 123 ok", [CARD]), "before": (f"no 12 {CARD} ok", [CARD]),
        "dashed": (f"pay {DASHED}-12 now", [DASHED]), "both": (f"x {CARD} 5500 0000 0000 0004 y", [CARD, "5500 0000 0000 0004"]),
        "currency": (f"to {AT} EUR 500", [AT]), "bank": (f"to {ES} BANK", [ES]), "two": (f"{AT} {ES}", [AT, ES]),
        "mixed": (f"{AT} {CARD} 2000-02-29", [AT, CARD, "2000-02-29"]),
        "inside": ("ref 1234 5678 9012 3456 078-05-1120 end", ["078-05-1120"]),
    }
    many = " ".join(["10"] * 30_000)
    same = {
        "bad": "pay 4111 1111 1111 1112 now", "bad iban": "to AT61 1904 3002 3457 3202 EUR", "glued": "id 4111111111111111-abc",
        "letters": "x4111111111111111", "short": "1 2 3", "many": many, "null": None,
    }
    rows = [(k, v[0]) for k, v in cases.items()] + list(same.items())
    frame = pseudonyms.pseudonymise(spark.createDataFrame(rows, "doc_id string, text string"), key=KEY, found_col="kinds")
    assert not any(n in plan(frame) for n in PYTHON_NODES)
    found = {r.doc_id: r for r in frame.collect()}
    for name, (text, values) in cases.items():
        shape = re.escape(text)
        for value in values:
            letters = re.sub("[A-Z]", "[A-Z]", re.sub("[0-9]", "[0-9]", re.escape(value)))
            shape = shape.replace(re.escape(value), f"({letters})", 1)
        new = re.fullmatch(shape, found[name].text)
        assert new and len(found[name].kinds) == len(values), (name, found[name])
        for old, value, kind in zip(values, new.groups(), found[name].kinds):
            assert value != old
            assert kind != "card" or luhn(re.sub("[^0-9]", "", value))
            assert kind != "iban" or iban_ok(value)
    for name, text in same.items():
        # A valid number may stand in a long run by chance; all that is asked for there is an end.
        assert found[name].text == text or name == "many", name
    assert len(found["many"].text) == len(many)


def test_long_runs_end(spark):
    rng = random.Random(1)
    cards = []
    while len(cards) < 1_000:
        number = f"4{rng.randrange(10**14):014d}"
        cards.append(next(number + str(d) for d in range(10) if luhn(number + str(d))))
    texts = {
        "labels": "x1@" + "a." * 20_000 + "1", "letters": "a" * 1_000_000, "dots": "." * 300_000, "ats": "a@" * 50_000,
        "hyphens": "x@" + "a-" * 50_000, "digits": "1" * 300_000, "capitals": "AB12" * 50_000,
    }
    same = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    found = {r.doc_id: r.text for r in pseudonyms.pseudonymise(same, key=KEY).collect()}
    assert found == texts
    numbers = spark.createDataFrame([("cards", " x ".join(cards))], "doc_id string, text string")
    row = pseudonyms.pseudonymise(numbers, key=KEY, found_col="kinds").first()
    new = row.text.split(" x ")
    assert row.kinds == ["card"] * 1_000 and all(map(luhn, new)) and sum(a == b for a, b in zip(new, cards)) < 5


def test_addresses(spark):
    cases = {
        "a@b.com": ["a@b.com"], "x@y.co.uk, z": ["x@y.co.uk"], "a@b.com.x@y.org": ["a@b.com", ".x@y.org"], "a@b": [], "@b.com": [],
        "é.ü+1@mail-1.example": ["é.ü+1@mail-1.example"], "x@10.0.0.1": ["10.0.0.1"], "a@b.com1": ["a@b.com"], "a@-b.com": [], "a@b-.com": [],
        "n@" + "l." * 126 + "org": ["n@" + "l." * 126 + "org"], "l" * 90 + "@b.org": ["l" * 90 + "@b.org"],
    }
    frame = spark.createDataFrame([(t,) for t in cases], "text string")
    kept = pseudonyms.pseudonymise(frame.withColumn("old", F.col("text")), key=KEY, found_col="kinds").collect()
    assert {r.old: len(r.kinds) for r in kept} == {t: len(v) for t, v in cases.items()}
    for r in kept:
        assert len(r.text) == len(r.old) or r.kinds == ["ip"]
        assert (r.text == r.old) == (not r.kinds)
