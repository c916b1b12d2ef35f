"""Conversation repair against a search that keeps every path."""

from __future__ import annotations

import hashlib
import itertools
import random

import pytest

from delayflow.llm import queries, repair

TURNS = "conv_id long, turn long, role string, text string, place int"


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.rstrip(repair.SPACE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def brute(rows):
    """Cost, audit and lines of the best edits: all of them, kept per grammar state as whole strings."""
    grammar = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    paths = {"": {(0, "", ())}}

    def closed(paths):
        out = {state: set(found) for state, found in paths.items()}
        for _ in range(3):
            for state, found in list(out.items()):
                for initial, role in (("u", "user"), ("a", "assistant")):
                    if (state, initial) in grammar:
                        new = {(c + 3, audit + "I", lines + (f"{role}:",)) for c, audit, lines in found}
                        out.setdefault(grammar[state, initial], set()).update(new)
        return out

    for (_, _, role, text), fault in zip(rows, faults_of(rows)):
        new = {}
        for state, found in closed(paths).items():
            for cost, audit, lines in found:
                new.setdefault(state, set()).add((cost + 4, audit + "D", lines))
                if fault in ("blank", "duplicate"):
                    continue
                cut = 3 if fault else 0
                options = [("K", 0, role)] if role[:1] in ("s", "u", "a") else []
                for edit, paid, given in [*options, ("R", 3, "user"), ("R", 3, "assistant")]:
                    to = grammar.get((state, given[:1]))
                    if to and not (edit == "R" and given[:1] == "s"):
                        new.setdefault(to, set()).add((cost + cut + paid, audit + edit, (*lines, f"{given}:{text}")))
        # From any state two inserts reach any other, so dearer ways by more than that are no use.
        least = min(p[0] for found in new.values() for p in found)
        paths = {s: {p for p in found if p[0] <= least + 6} for s, found in new.items()}
    cost, audit, lines = min(p for state, found in closed(paths).items() if state in ("", "a") for p in found)
    return cost, audit, "\n".join(lines)


def ordered(rows):
    given = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    return sorted(given, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))


def expected(rows):
    rows = ordered(rows)
    turns = [t for _, t, _, _ in rows if t is not None]
    faults = faults_of(rows)
    pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(rows)]
    cost, audit, lines = brute(rows)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, sum(p not in repair.LEGAL for p in pairs), cost, audit, hashlib.sha256(lines.encode()).hexdigest())


def conversation(rng, conv_id, n):
    roles = ["system", "user", "assistant", "tool", None, "sa", ""]
    texts = ["Yes.", "No", "  ", "", "Why?\n", "So...", None, "ü!", "x. y", "Yes.\x0b"]
    return [
        (conv_id, rng.choice([None, *range(2 * n)]) if n < 9 else i, rng.choices(roles, [2, 8, 8, 1, 1, 1, 1])[0], rng.choice(texts) if n < 9 else f"{rng.choice(texts)}{i % 50}.")
        for i in range(n)
    ]


@pytest.mark.parametrize("segment", [4_096, 3])
def test_repairs_are_the_cheapest(spark, segment):
    rng = random.Random(8)
    chats = {i: conversation(rng, i, rng.randrange(1, 9)) for i in range(60)}
    chats[None] = conversation(rng, None, 8)
    chats[99] = [(99, 1, "user", " ")] * 4
    said = [(*row, 7) for rows in chats.values() for row in rows]
    found = repair.repair(spark.createDataFrame(said, TURNS), segment=segment)
    hashes = dict(repair.digests(found.messages, segment).collect())
    assert found.reports.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    got = {r.conv_id: (*r[1:], hashes.get(r.conv_id, hashlib.sha256(b"").hexdigest())) for r in found.reports.collect()}
    assert got == {i: expected(rows) for i, rows in chats.items()}
    for r in found.messages.collect():
        assert r.edit != "I" or r.text == ""
    assert len(repair.repair(spark.createDataFrame(said, TURNS).limit(0)).reports.collect()) == 0


def test_memory_is_bounded_and_ties_are_compared_whole():
    rng = random.Random(3)
    codes = ["".join(c) for c in itertools.product("suax", ".~!")]
    for n in (1, 2, 5, 300):
        rows = [rng.choices(codes, [3 if c[1] == "." else 1 for c in codes])[0] for _ in range(n)]
        survivors, decided, held = repair.Survivors(repair.BEGIN), [], 0
        plain = {repair.BEGIN: (0, "")}
        for code in rows:
            decided += survivors.step(repair.moves(code))
            held = max(held, max(len(x) for _, _, x in survivors.ends()))
            new = {}
            for state, (cost, steps) in plain.items():
                for to, paid, label in repair.moves(code)[state]:
                    new[to] = min(new.get(to, (1 << 60, "")), (cost + paid, steps + label))
            plain = new
        ends = {s: (c, "".join(decided + x)) for s, c, x in survivors.ends()}
        assert ends.items() <= plain.items()
        best = repair.finish((s, c, [x]) for s, (c, x) in plain.items())
        assert repair.finish((s, c, [x]) for s, (c, x) in ends.items()) == best
        assert n < 300 or (len(decided) > 200 and held < 100)
        # Cut anywhere, the parts give the same path.
        whole = "".join(rows)
        at = 2 * rng.randrange(n + 1)
        joined = {}
        for state, cost, steps in repair.search(whole[:at], repair.BEGIN):
            for to, paid, more in repair.search(whole[at:], state):
                joined[to] = min(joined.get(to, (1 << 60, "")), (cost + paid, steps + more))
        assert repair.finish((s, c, [x]) for s, (c, x) in joined.items()) == best


def test_a_long_conversation_in_segments(spark):
    rng = random.Random(11)
    said = [(*row, 0) for row in conversation(rng, 1, 700)]
    table = spark.createDataFrame(said, TURNS)
    whole, cut = repair.repair(table), repair.repair(table, segment=16)
    assert whole.reports.collect() == cut.reports.collect()
    assert repair.digests(whole.messages).collect() == repair.digests(cut.messages, 16).collect()
    assert repair.digests(whole.messages, 5).collect() == repair.digests(cut.messages).collect()
    messages = sorted(cut.messages.collect(), key=lambda r: (r.place, r.part))
    initials = "".join(m.role[:1] for m in messages)
    assert initials.removeprefix("s").replace("ua", "") == ""


def test_damage(spark, sf_dir):
    turns = spark.createDataFrame([(None, None, None, None), (1, None, "user", "A. b! c?")], "conv_id long, turn long, role string, text string")
    assert {r.role for r in queries.damaged(turns).collect()} <= {" ", "user"}
    source = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    ids = {r.conv_id for r in source.select("conv_id").collect()}
    found = queries.op13(spark, sf_dir).collect()
    assert {r.conv_id for r in found} == ids and len(found) == len(ids)
    chats = {}
    for r in queries.damaged(source).collect():
        chats.setdefault(r.conv_id, []).append(tuple(r))
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert {r.conv_id: tuple(r[1:]) for r in found} == {i: expected(chats[i]) if i in chats else empty for i in ids}
