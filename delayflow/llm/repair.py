"""Conversation structure repair: the cheapest edits that give system?(user assistant)*.

A conversation is a path through four states (nothing yet, after the system message, after a user,
after an assistant). Its rows are kept, given another role or deleted, and missing rows inserted; of the
cheapest paths the one whose edits come first in the alphabet is taken. A Viterbi search holds one
survivor per state in a tree of back pointers; references are counted, and what all survivors
share is given out and forgotten. Rows are searched in segments of bounded size, from each
state in which a segment may begin, and the same search over whole segments then picks one path.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delayflow.operators.joins import join_dimension
from delayflow.operators.ordering import number_rows
from delayflow.workspace import materialize

# Costs of edits.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# Characters that are no text, and those that end a text.
SPACE = " \t\n\x0b\x0c\r"
STOPS = (".", "!", "?")
# What stands for a NULL role or text.
MISSING = " "
# Rows of a segment.
SEGMENT = 4_096

# States: nothing yet, after the system message, after a user, after an assistant.
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(BEGIN, "s"): SYSTEM, (BEGIN, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
# Inserts that lead from a state to others; more would come back to one that was free.
INSERTS = {
    BEGIN: [("", BEGIN), ("Iu", USER), ("IuIa", ASSISTANT)],
    SYSTEM: [("", SYSTEM), ("Iu", USER), ("IuIa", ASSISTANT)],
    USER: [("", USER), ("Ia", ASSISTANT)],
    ASSISTANT: [("", ASSISTANT), ("Iu", USER)],
}
# What the rest of a conversation costs at most more from the second state than from the first:
# the inserts between them, a system message that has to go, or a turn where none is needed. A
# survivor dearer than another by more than that is never part of the path.
DEARER = {
    (BEGIN, SYSTEM): 2 * INSERT, (BEGIN, USER): DELETE + INSERT, (BEGIN, ASSISTANT): DELETE,
    (SYSTEM, BEGIN): 0, (SYSTEM, USER): INSERT, (SYSTEM, ASSISTANT): 0,
    (USER, BEGIN): INSERT, (USER, SYSTEM): INSERT, (USER, ASSISTANT): INSERT,
    (ASSISTANT, BEGIN): 0, (ASSISTANT, SYSTEM): 2 * INSERT, (ASSISTANT, USER): INSERT,
}
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")

# A step is the edits of a row, each with the initial of the role it gives, those inserted before it first.
STEP = r"(?:I[ua])*[KRD].(?:(?:I[ua])+\z)?"

Move = tuple[int, int, str]


@functools.cache
def moves(code: str) -> dict[int, list[Move]]:
    """Ways over one row from each state: state behind it, cost and step, the best per state.

    A code is the initial of a role (s, u, a or x) and ``.`` for a row that may stay, ``~``
    for one that may stay truncated, ``!`` for one that has to go.
    """
    initial, fault = code
    cut = TRUNCATED if fault == "~" else 0
    found: dict[int, list[Move]] = {}
    for state, ways in INSERTS.items():
        best: dict[int, tuple[int, str]] = {}
        for inserted, at in ways:
            paid = INSERT * (len(inserted) // 2)
            edits = [(at, paid + DELETE, "D-")]
            if fault != "!":
                if (at, initial) in NEXT:
                    edits.append((NEXT[at, initial], paid + cut, f"K{initial}"))
                edits += [(NEXT[at, r], paid + REROLE + cut, f"R{r}") for r in ROLES if (at, r) in NEXT]
            for behind, cost, edit in edits:
                best[behind] = min(best.get(behind, (1 << 60, "")), (cost, inserted + edit))
        found[state] = [(behind, *way) for behind, way in best.items()]
    return found


class _Node:
    __slots__ = ("parent", "label", "kids", "held")

    def __init__(self, parent: _Node | None, label: str) -> None:
        self.parent, self.label, self.kids, self.held = parent, label, [], 0


class Survivors:
    """One cheapest path per state, in a tree of which only what is not decided is held.

    Paths of equal cost to one state are compared by all their labels since they parted. They
    have as many row edits, so neither can be the beginning of the other.
    """

    def __init__(self, start: int) -> None:
        self.root = _Node(None, "")
        self.tips = {start: (0, self.root)}
        self.root.held = 1

    def step(self, ways: dict[int, list[Move]]) -> list[str]:
        """Go on by one label; gives the labels that are decided now, in order."""
        best: dict[int, tuple[int, _Node, str]] = {}
        for state, (paid, tip) in self.tips.items():
            for behind, cost, label in ways.get(state, ()):
                known = best.get(behind)
                cost += paid
                if known is None or cost < known[0] or (cost == known[0] and self._less(tip, label, known[1], known[2])):
                    best[behind] = (cost, tip, label)
        old, self.tips = self.tips, {}
        for behind, (cost, parent, label) in best.items():
            if any(cost > other + DEARER[behind, s] for s, (other, _, _) in best.items() if s != behind):
                continue
            node = _Node(parent, label)
            node.held = 1
            parent.kids.append(node)
            self.tips[behind] = (cost, node)
        for _, tip in old.values():
            tip.held -= 1
            self._release(tip)
        return self._decided()

    def _less(self, a: _Node, to_a: str, b: _Node, to_b: str) -> bool:
        left, right = [to_a], [to_b]
        while a is not b:
            left.append(a.label)
            right.append(b.label)
            a, b = a.parent, b.parent
        return "".join(reversed(left)) < "".join(reversed(right))

    def _release(self, node: _Node) -> None:
        while node is not self.root and not node.held and not node.kids:
            node.parent.kids.remove(node)
            node = node.parent

    def _decided(self) -> list[str]:
        out = []
        # The last label stays, as inserts at the end may be added to it.
        while not self.root.held and len(self.root.kids) == 1 and not self.root.kids[0].held:
            self.root = self.root.kids[0]
            self.root.parent = None
            out.append(self.root.label)
        return out

    def undecided(self, node: _Node) -> list[str]:
        """Labels of a tip since the last that was given out."""
        out = []
        while node is not self.root:
            out.append(node.label)
            node = node.parent
        return out[::-1]

    def ends(self) -> list[tuple[int, int, list[str]]]:
        """State, cost and undecided labels of each survivor."""
        return [(state, cost, self.undecided(tip)) for state, (cost, tip) in self.tips.items()]


def finish(ends: Iterable[tuple[int, int, list[str]]]) -> tuple[int, list[str]]:
    """Cost and labels of the path to take, with what has to be inserted at its end."""
    found = []
    for state, cost, labels in ends:
        for inserted, last in INSERTS[state]:
            if last in (BEGIN, ASSISTANT):
                found.append((cost + INSERT * (len(inserted) // 2), "".join(labels) + inserted, labels, inserted))
    cost, _, labels, inserted = min(found, key=lambda f: f[:2])
    return cost, [*labels[:-1], labels[-1] + inserted]


def search(codes: str, start: int) -> list[tuple[int, int, str]]:
    """State, cost and steps of the best path over a segment to each state it may end in."""
    survivors, decided = Survivors(start), []
    for i in range(0, len(codes), 2):
        decided += survivors.step(moves(codes[i : i + 2]))
    head = "".join(decided)
    return [(state, cost, head + "".join(tail)) for state, cost, tail in survivors.ends()]


def illegal_pairs(initials: str) -> int:
    return sum(initials[i : i + 2] not in LEGAL for i in range(len(initials) - 1))


@dataclass
class Repair:
    """``messages``: conv_id, place, part, edit, role, text. ``reports``: one row per conversation."""

    messages: DataFrame
    reports: DataFrame


def repair(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    segment: int = SEGMENT,
) -> Repair:
    """Repaired messages of all conversations, and what was wrong with each and done to it.

    Rows are taken by turn, NULL turns first; ties are ordered by role and text, repeated rows are
    duplicates. The first fault of a row counts: blank (no text but white space), duplicate (role
    and text seen earlier), truncated (the text does not end with a full stop or the like). Blank
    and duplicate rows have to go. NULL roles and texts are one space; NULL conversations are one
    conversation. Roles are told by their initial. A report has conv_id, gaps, blank, duplicate,
    truncated, illegal, cost and audit, the edits' initials in order. Messages are ordered by ``place``
    and ``part``. Other columns are not read; no rows give none. A conversation of any length is
    searched in segments of at most ``segment`` rows; its audit alone is gathered.
    """
    rows = turns.select(
        F.col(f"`{conversation}`").alias("conv_id"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(MISSING)).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit(MISSING)).alias("text"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    placed = materialize(number_rows(rows, order, "place"), "placed")
    marked = materialize(_marked(placed), "marked")
    plan = materialize(_chosen(_segments(marked, segment)), "plan")
    return Repair(_messages(placed, plan), _reports(marked, plan))


def _marked(placed: DataFrame) -> DataFrame:
    """Rows without their texts: conv_id, turn, place, initial and fault (., ~, blank, duplicate)."""
    said = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    slim = materialize(
        placed.select(
            "conv_id", "turn", "place", digest.alias("digest"),
            F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
            F.when(said == "", "blank").when(F.right(said, F.lit(1)).isin(*STOPS), ".").otherwise("~").alias("own"),
        ),
        "faults",
    )
    # Places are unique, so no key of this join is hot however often a text is repeated.
    firsts = slim.groupBy("conv_id", "digest").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    told = join_dimension(slim, firsts, ["place"], "left")
    fault = F.when(F.col("own") == "blank", "blank").when(F.col("first").isNull(), "duplicate").otherwise(F.col("own"))
    return told.select("conv_id", "turn", "place", "initial", fault.alias("fault"))


def _segments(marked: DataFrame, segment: int) -> DataFrame:
    """Per conversation and block of places the best ways over its rows."""
    code = F.concat("initial", F.when(F.col("fault").isin("blank", "duplicate"), "!").otherwise(F.col("fault")))
    grouped = marked.groupBy("conv_id", F.floor(F.col("place") / segment).alias("block")).agg(
        F.min("place").alias("first"), F.sort_array(F.collect_list(F.struct("place", code.alias("code")))).alias("rows")
    )
    coded = grouped.select("conv_id", "block", "first", F.array_join(F.col("rows.code"), "").alias("codes"))
    way = T.StructType(
        [T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
         T.StructField("cost", T.LongType()), T.StructField("steps", T.StringType())]
    )
    added = [T.StructField("initials", T.StringType()), T.StructField("illegal", T.LongType()), T.StructField("ways", T.ArrayType(way))]
    schema = T.StructType([*coded.schema.fields[:3], *added])
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("steps", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            outer, illegal, ways = [], [], []
            for first, codes in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                initials = codes[::2]
                outer.append(initials[0] + initials[-1])
                illegal.append(illegal_pairs(initials))
                # Only a segment at the edge of a block may go on with an earlier one.
                starts = (BEGIN,) if first % segment else (BEGIN, SYSTEM, USER, ASSISTANT)
                ways.append([(s, *found) for s in starts for found in search(codes, s)])
            columns = [pa.array(outer, pa.string()), pa.array(illegal, pa.int64()), pa.array(
                [[dict(zip(("start", "end", "cost", "steps"), w)) for w in one] for one in ways], kind)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], names=schema.names)

    return coded.mapInArrow(run, schema)


def _streamed(df: DataFrame, order: Sequence[str], schema: T.StructType, begin: Callable) -> DataFrame:
    """Rows of a conversation in order through one object, which ``begin`` makes of its id.

    The object has ``add(row)`` and ``end()``, which give rows. Conversations of a task follow
    one another, so no more of them is held than the object keeps.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = schema.names
        kinds = None
        running, now, key = None, None, object()
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                now = row["conv_id"]
                if running is None or now != key:
                    if running is not None:
                        out += running.end()
                    running, key = begin(now), now
                out += running.add(row)
            kinds = kinds or {"conv_id": batch.schema.field("conv_id").type, **_KINDS}
            yield _batch(out, names, kinds)
        if running is not None:
            yield _batch(running.end(), names, kinds)

    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order).mapInArrow(run, schema)


_KINDS = {"block": pa.int64(), "first": pa.int64(), "steps": pa.string(), "cost": pa.int64(), "illegal": pa.int64(), "sha256": pa.string()}


def _batch(rows: list[tuple], names: list[str], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[n]) for n, c in zip(names, columns)], names=names)


class _Chain:
    """Segments of one conversation: those that are decided are given out, the others held."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.survivors = conv_id, Survivors(BEGIN)
        self.waiting: list[tuple[int, int]] = []
        self.illegal, self.last = 0, ""

    def add(self, row: dict) -> list[tuple]:
        self.illegal += row["illegal"] + illegal_pairs(self.last + row["initials"][0])
        self.last = row["initials"][-1]
        self.waiting.append((row["block"], row["first"]))
        ways: dict[int, list[Move]] = {}
        for w in row["ways"]:
            ways.setdefault(w["start"], []).append((w["end"], w["cost"], w["steps"]))
        return self._given(self.survivors.step(ways))

    def _given(self, labels: list[str], cost: int = 0, illegal: int = 0) -> list[tuple]:
        done, self.waiting = self.waiting[: len(labels)], self.waiting[len(labels) :]
        rows = [(self.conv_id, *place, steps, 0, 0) for place, steps in zip(done, labels)]
        if rows and (cost or illegal):
            rows[-1] = (*rows[-1][:4], cost, illegal)
        return rows

    def end(self) -> list[tuple]:
        cost, labels = finish(self.survivors.ends())
        return self._given(labels, cost, self.illegal)


def _chosen(segments: DataFrame) -> DataFrame:
    """Columns conv_id, block, first, steps, and cost and illegal of a conversation in its last row."""
    long = T.LongType()
    schema = T.StructType(
        [segments.schema["conv_id"], T.StructField("block", long), T.StructField("first", long),
         T.StructField("steps", T.StringType()), T.StructField("cost", long), T.StructField("illegal", long)]
    )
    return _streamed(segments, ["block"], schema, _Chain)


def _messages(placed: DataFrame, plan: DataFrame) -> DataFrame:
    each = plan.select("first", F.posexplode(F.regexp_extract_all("steps", F.lit(STEP), F.lit(0))).alias("at", "step"))
    steps = each.select((F.col("first") + F.col("at")).alias("place"), "step")
    told = join_dimension(placed, steps, ["place"], "inner")
    edits = F.posexplode(F.regexp_extract_all("step", F.lit(".."), F.lit(0))).alias("part", "edit")
    kind, gives = F.left("edit", F.lit(1)), F.right("edit", F.lit(1))
    given = F.when(kind == "K", F.col("role")).when(gives == "u", ROLES["u"]).otherwise(ROLES["a"])
    return (
        told.select("conv_id", "place", "role", "text", edits)
        .filter(kind != "D")
        .select(
            "conv_id", "place", "part", kind.alias("edit"), given.alias("role"),
            F.when(kind == "I", "").otherwise(F.col("text")).alias("text"),
        )
    )


def _reports(marked: DataFrame, plan: DataFrame) -> DataFrame:
    # Turns are told apart before the shuffle; their number is compared with their range.
    fault = F.col("fault")
    counted = marked.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.count_if(fault == name).alias(name) for name in ("blank", "duplicate")],
        F.count_if(fault == "~").alias("truncated"),
    )
    audit = F.regexp_replace("steps", "(.).", "$1").alias("audit")
    done = plan.groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.sort_array(F.collect_list(F.struct("block", audit)))["audit"], "").alias("audit"),
    )
    # A struct is never NULL, so the NULL conversation meets its own row.
    same = F.struct("conv_id").alias("_same")
    both = join_dimension(counted.withColumn("_same", same), done.select(same, "illegal", "cost", "audit"), ["_same"], "inner")
    return both.drop("_same")


class _Digest:
    """SHA-256 of the lines of one conversation, fed in order."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.hash, self.begun = conv_id, hashlib.sha256(), False

    def add(self, row: dict) -> list[tuple]:
        self.hash.update((b"\n" if self.begun else b"") + row["lines"].encode("utf-8", "surrogatepass"))
        self.begun = True
        return []

    def end(self) -> list[tuple]:
        return [(self.conv_id, self.hash.hexdigest())]


def digests(messages: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Columns conv_id and sha256 of ``role:text`` of all messages of a conversation, a line each.

    Lines are put together by blocks of places first; only the blocks of a conversation, not
    its messages, meet in one task, which holds one of them at a time.
    """
    line: Column = F.concat("role", F.lit(":"), "text")
    blocks = messages.groupBy("conv_id", F.floor(F.col("place") / segment).alias("block")).agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("place", "part", line.alias("line"))))["line"], "\n").alias("lines")
    )
    schema = T.StructType([messages.schema["conv_id"], T.StructField("sha256", T.StringType())])
    return _streamed(blocks, ["block"], schema, _Digest)
