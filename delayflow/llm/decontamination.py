"""Benchmark decontamination: token windows of documents against a set of test n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delayflow.llm.arrow import fresh_name, slices
from delayflow.workspace import materialize

WINDOW = 10
# Bytes of test items that one broadcast set may hold; more items are scanned in more passes.
SET_BYTES = 8 * 1024 * 1024

# ASCII letters are lowered, digits kept, bytes of other characters kept, the rest parts words.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def fold_words(text: str | None) -> list[bytes]:
    """Words of letters, digits and characters beyond ASCII, in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def rolling(ids: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of each window of ``length`` ids."""
    count = len(ids) - length + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for i in range(length):
        out = (out + ids[i : i + count]) * MULTIPLIER
        out ^= out >> np.uint64(29)
    return out


class WindowSet:
    """Windows of test items: sorted hashes, and where in the items each window starts.

    Hashes find candidates; the words themselves decide. An item of fewer words than
    ``window``, but not none, is one window.
    """

    def __init__(self, items: Sequence[tuple[str, str | None]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        flat, by_length, begin = [], {}, 0
        for name, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in fold_words(text)]
            if not ids:
                continue
            length = min(window, len(ids))
            starts = by_length.setdefault(length, [])
            starts.extend((begin + i, number[name]) for i in range(len(ids) - length + 1))
            flat.extend(ids)
            begin += len(ids)
        self.ids = np.array(flat, np.uint64)
        self.windows = {}
        for length, found in by_length.items():
            # Equal windows are one, with all items that have them; a hash may stand for several.
            owners: dict[bytes, set[int]] = {}
            first: dict[bytes, int] = {}
            for start, owner in found:
                words = self.ids[start : start + length].tobytes()
                owners.setdefault(words, set()).add(owner)
                first.setdefault(words, start)
            starts = np.fromiter(first.values(), np.int64, len(first))
            hashes = rolling(self.ids, length)[starts]
            order = np.argsort(hashes, kind="stable")
            held = list(owners.values())
            self.windows[length] = hashes[order], starts[order], [held[i] for i in order.tolist()]

    def hits(self, words: list[bytes]) -> tuple[list[list[int]], list[str]]:
        """Spans of words inside an occurrence of a window, and the items hit."""
        known = self.vocabulary.get
        ids = np.fromiter((known(w, 0) for w in words), np.uint64, len(words))
        edges = np.zeros(len(words) + 1, np.int64)
        items: set[int] = set()
        for length, (hashes, starts, owners) in self.windows.items():
            rolled = rolling(ids, length)
            low = np.searchsorted(hashes, rolled)
            inside = np.flatnonzero(low < len(hashes))
            met: set[int] = set()
            for at in inside[hashes[low[inside]] == rolled[inside]].tolist():
                place = int(low[at])
                # Different windows of one hash are next to each other; only one can be equal.
                while place < len(hashes) and hashes[place] == rolled[at]:
                    begin = int(starts[place])
                    if (self.ids[begin : begin + length] == ids[at : at + length]).all():
                        edges[at] += 1
                        edges[at + length] -= 1
                        if place not in met:
                            met.add(place)
                            items |= owners[place]
                        break
                    place += 1
        covered = np.cumsum(edges[:-1]) > 0
        changes = np.flatnonzero(np.diff(covered, prepend=False, append=False))
        return changes.reshape(-1, 2).tolist(), [self.names[i] for i in sorted(items)]


def item_groups(
    benchmark: DataFrame, item_col: str, text_col: str, limit: int = SET_BYTES
) -> list[DataFrame]:
    """Items dealt to groups of some half of ``limit`` bytes of text, at most one per item."""
    stored = materialize(
        benchmark.select(
            F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
            F.col(text_col).alias("text"),
        ),
        "items",
    )
    size = F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")
    total = stored.agg(size).first()["bytes"]
    if total <= limit:
        return [stored]
    parts = -(-2 * total // limit)
    spread = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    return [stored.filter(spread == part) for part in range(parts)]


def mark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    set_bytes: int = SET_BYTES,
    hits_col: str = "hits",
) -> DataFrame:
    """Add a struct ``hits_col`` of n_words, spans ``[first, end)`` in words, and items.

    The windows of the items are broadcast as a set of hashes with the words behind them.
    Items of more than ``set_bytes`` of text are scanned in several passes, each with a set
    within the bound; between passes the documents are stored, so one set at a time is held.
    Rows are passed through as they are, repeated ones too. A NULL or empty text has no words
    and no hit; items without words are never hit; items with equal ids count once. Every
    other column is kept, whatever its name (``hits_col`` has to be a new one).
    """
    found = T.StructType(
        [
            T.StructField("n_words", T.LongType()),
            T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
            T.StructField("items", T.ArrayType(T.StringType())),
        ]
    )
    kind = pa.struct(
        [
            ("n_words", pa.int64()),
            ("spans", pa.list_(pa.list_(pa.int64()))),
            ("items", pa.list_(pa.string())),
        ]
    )

    def scan(frame: DataFrame, group: DataFrame, name: str) -> DataFrame:
        items = [(r["item"], r["text"]) for r in group.collect()]
        shared = frame.sparkSession.sparkContext.broadcast(WindowSet(items, window))
        at = frame.columns.index(text_col)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            windows = shared.value
            for batch in slices(batches):
                rows = []
                for text in batch.column(at).to_pylist():
                    words = fold_words(text)
                    spans, items = windows.hits(words)
                    rows.append({"n_words": len(words), "spans": spans, "items": items})
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(rows, kind)], names=[*batch.schema.names, name]
                )

        schema = T.StructType([*frame.schema.fields, T.StructField(name, found)])
        return frame.mapInArrow(run, schema)

    groups = item_groups(benchmark, item_col, item_text_col, set_bytes)
    marked = docs
    columns: list[str] = []
    for group in groups:
        name = hits_col if len(groups) == 1 else fresh_name(marked, "_pass")
        marked = scan(marked, group, name)
        columns.append(name)
        if len(groups) > 1:
            marked = materialize(marked, "marked")
    if len(groups) == 1:
        return marked
    merged = F.struct(
        F.col(columns[0])["n_words"].alias("n_words"),
        F.flatten(F.array(*[F.col(c)["spans"] for c in columns])).alias("spans"),
        F.array_distinct(F.flatten(F.array(*[F.col(c)["items"] for c in columns]))).alias("items"),
    )
    return marked.withColumn(hits_col, merged).drop(*columns)


def n_hit(hits: str) -> Column:
    """Number of words inside any span; spans of several passes may overlap."""
    places = F.transform(
        F.col(hits)["spans"], lambda s: F.sequence(s[0], s[1] - 1)
    )
    return F.size(F.array_distinct(F.flatten(places))).cast("long")


def drop_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any hit, with their own columns."""
    name = fresh_name(docs, "_hits")
    marked = mark_hits(docs, benchmark, hits_col=name, **options)
    return marked.filter(F.size(F.col(name)["spans"]) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """All documents, each hit span cut out of the text from its first to its last word.

    Texts without a hit are left byte for byte as they are.
    """
    name = fresh_name(docs, "_hits")
    marked = mark_hits(docs, benchmark, text_col=text_col, hits_col=name, **options)
    at, spans_at = docs.columns.index(text_col), len(docs.columns)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(at).to_pylist()
            for row, hit in enumerate(batch.column(spans_at).to_pylist()):
                if hit["spans"]:
                    texts[row] = without_spans(texts[row], hit["spans"])
            columns = list(batch.columns[:spans_at])
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:spans_at])

    return marked.mapInArrow(cut, docs.schema)


def without_spans(text: str, spans: Sequence[Sequence[int]]) -> str:
    """``text`` without the bytes from the first to the last word of each span."""
    raw = text.encode("utf-8", "surrogatepass")
    words = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(FOLD))]
    kept, end = [], 0
    for first, past in sorted(map(tuple, spans)):
        begin, stop = words[first][0], words[past - 1][1]
        kept.append(raw[end : max(begin, end)])
        end = max(stop, end)
    return b"".join([*kept, raw[end:]]).decode("utf-8", "surrogatepass")
