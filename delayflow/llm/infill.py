"""Fill-in-middle: documents cut in three by units of text and put together in another order.

A text is cut into chunks where a rolling hash of its bytes says so, so documents that share a
passage share its chunks wherever it stands. What is worth knowing of a chunk is its summary: its
characters, the ends of words inside it, and whether it begins and ends within a word. Summaries
are kept by content in each task, and those of neighbours combine to the units of the whole text;
only the chunks in which a cut falls are looked at again.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delayflow.llm.arrow import fresh_name, slices

# Marks of the parts, and shares in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
INFILL_PERCENT = 50
SUFFIX_FIRST_PERCENT = 80

# Bytes the rolling hash looks back on, a power of two; leading bits that are zero at a cut.
WINDOW = 32
CUT_BITS = 11
LEAST_CHUNK, LARGEST_CHUNK = 256, 16_384
# Bytes hashed at once, and bytes of chunks that a task remembers.
HASH_BLOCK = 1 << 20
CACHE_BYTES = 64 << 20

# A random-looking number per byte value, from a hash of the value.
GEAR = np.array(
    [int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=4).digest(), "little") for b in range(256)],
    np.uint32,
)


def rolling_hashes(block: np.ndarray) -> np.ndarray:
    """Per byte the sum of the numbers of the last ``WINDOW`` bytes, each shifted by its age."""
    hashes, age = GEAR[block], 1
    while age < WINDOW:
        # The hash of twice as many bytes is made of two of so many.
        older = hashes[:-age] << np.uint32(age)
        hashes = hashes.copy()
        hashes[age:] += older
        age *= 2
    return hashes


def chunk_edges(data: np.ndarray) -> list[int]:
    """Edges of the chunks of a text's bytes, from 0 to its length."""
    found = []
    for start in range(0, len(data), HASH_BLOCK):
        before = max(0, start - WINDOW + 1)
        hashes = rolling_hashes(data[before : start + HASH_BLOCK])[start - before :]
        found += (np.flatnonzero(hashes >> np.uint32(32 - CUT_BITS) == 0) + start + 1).tolist()
    edges, at = [0], 0
    while at < len(data):
        place = bisect_left(found, at + LEAST_CHUNK)
        at = min(found[place] if place < len(found) else len(data), at + LARGEST_CHUNK, len(data))
        edges.append(at)
    return edges


@dataclass(frozen=True)
class Summary:
    """A chunk's characters, words that end inside it, and whether its outer bytes are of words."""

    chars: int
    ends: int
    opens: bool
    closes: bool


def _blank(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_ends(data: np.ndarray) -> np.ndarray:
    """Places behind the words that end inside the bytes; one cut by the end is not among them."""
    blank = _blank(data)
    return np.flatnonzero(~blank[:-1] & blank[1:]) + 1


def characters(data: np.ndarray) -> int:
    """Code points that begin in UTF-8 bytes."""
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def summarise(data: np.ndarray) -> Summary:
    outer = _blank(data[[0, -1]])
    return Summary(characters(data), len(word_ends(data)), not outer[0], not outer[1])


class Summaries:
    """Summaries of chunks by content, those not asked for lately forgotten.

    A chunk is found by the hash of its bytes and compared byte by byte, as keys of a dictionary
    are, so a summary is never another chunk's.
    """

    def __init__(self, limit: int = CACHE_BYTES) -> None:
        self.limit = limit // 2
        self.young: dict[bytes, Summary] = {}
        self.old: dict[bytes, Summary] = {}
        self.held = 0
        self.asked = self.known = 0

    def of(self, content: bytes) -> Summary:
        self.asked += 1
        summary = self.young.get(content)
        if summary is not None:
            self.known += 1
            return summary
        summary = self.old.get(content)
        if summary is None:
            summary = summarise(np.frombuffer(content, np.uint8))
        else:
            self.known += 1
        if self.held + len(content) > self.limit:
            self.old, self.young, self.held = self.young, {}, 0
        self.young[content] = summary
        self.held += len(content)
        return summary


class Units:
    """The units of a text: each a word with the white space before it, and white space at the end."""

    def __init__(self, text: bytes, cache: Summaries) -> None:
        self.data = np.frombuffer(text, np.uint8)
        self.edges = chunk_edges(self.data)
        parts = [cache.of(text[a:b]) for a, b in zip(self.edges, self.edges[1:])]
        # The last word of a chunk ends there if the next chunk does not go on with it.
        opens = [p.opens for p in parts[1:]] + [False]
        self.ends = list(accumulate((p.ends + (p.closes and not goes_on) for p, goes_on in zip(parts, opens)), initial=0))
        self.chars = list(accumulate((p.chars for p in parts), initial=0))
        self.count = self.ends[-1] + (1 if parts and not parts[-1].closes else 0)

    def cut(self, units: int) -> tuple[int, int]:
        """Bytes and characters that so many units take from the beginning."""
        if units >= self.count:
            return len(self.data), self.chars[-1]
        if not units:
            return 0, 0
        chunk = bisect_left(self.ends, units) - 1
        start, stop = self.edges[chunk], self.edges[chunk + 1]
        inside = word_ends(self.data[start:stop])
        nth = units - self.ends[chunk]
        place = start + int(inside[nth - 1]) if nth <= len(inside) else stop
        return place, self.chars[chunk] + characters(self.data[start:place])


def rearranged(
    text: bytes, draws: list[int], cache: Summaries, marks: tuple[bytes, bytes, bytes], infill: int, suffix_first: int
) -> tuple[int, str, int | None, int | None, bytes]:
    """Units, form, characters of prefix and middle, and output of one text."""
    units = Units(text, cache)
    if not text or any(m in text for m in marks) or draws[2] % 100 >= infill:
        return units.count, "plain", None, None, text
    first, second = sorted(d % (units.count + 1) for d in draws[:2])
    (a, before), (b, until) = units.cut(first), units.cut(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if draws[3] % 100 < suffix_first:
        form, output = "spm", marks[1] + suffix + marks[0] + prefix
    else:
        form, output = "psm", marks[0] + prefix + marks[1] + suffix
    return units.count, form, before, until - before, output + marks[2] + middle


def draws_of(key: Column, seed: int = SEED) -> Column:
    """Four numbers of 32 bits from the hash of the seed and a document's key."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digits, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)])


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    out_col: str = "infill",
    seed: int = SEED,
    infill_percent: int = INFILL_PERCENT,
    suffix_first_percent: int = SUFFIX_FIRST_PERCENT,
    marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
) -> DataFrame:
    """All rows and columns, and last a struct n, form, prefix_chars, middle_chars, output.

    ``marks`` stand before prefix, suffix and middle; each ends with a character that stands
    nowhere else in any of them, so that ``restore`` finds them for certain. ``form`` is ``plain``
    (the text as it is), ``psm`` or ``spm``.

    NULL and empty texts are plain with empty output; so are texts that contain a mark. A NULL id
    draws like empty text. Rows with equal id and text get equal results, rows that
    share only the id the same draws. The struct's name is made longer if a column has it; no documents
    give no rows. A text of any length is hashed in blocks; its row has to fit a task.
    """
    if len(set(marks)) < 3 or any(m[-1] in o[:-1] or len(m) < 2 for m in marks for o in marks):
        raise ValueError("marks must differ, and end with a character that no mark has elsewhere")
    name = fresh_name(docs, out_col)
    result = T.StructType(
        [
            T.StructField("n", T.LongType()),
            T.StructField("form", T.StringType()),
            T.StructField("prefix_chars", T.LongType()),
            T.StructField("middle_chars", T.LongType()),
            T.StructField("output", T.StringType()),
        ]
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    packed = docs.select(row, draws_of(F.col(f"`{id_col}`"), seed).alias("draws"))
    schema = T.StructType([packed.schema["row"], T.StructField(name, result)])
    place = docs.columns.index(text_col)
    encoded = tuple(m.encode() for m in marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Summaries()
        for batch in slices(batches):
            texts = batch.column(0).field(place).cast(pa.binary()).to_pylist()
            found = [
                rearranged(t or b"", d, cache, encoded, infill_percent, suffix_first_percent)
                for t, d in zip(texts, batch.column(1).to_pylist())
            ]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
            columns = [pa.array(values, kind) for values, kind in zip(zip(*found), kinds)]
            columns[4] = columns[4].view(pa.string())
            struct = pa.StructArray.from_arrays(columns, names=result.names)
            yield pa.RecordBatch.from_arrays([batch.column(0), struct], names=["row", name])

    return packed.mapInArrow(run, schema).select("row.*", name)


def restore(output: Column, form: Column, marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that an output was made of."""
    prefix, suffix, middle = marks

    def split(text: Column, mark: str) -> tuple[Column, Column]:
        return F.substring_index(text, mark, 1), F.substring_index(text, mark, -1)

    inner, tail = split(output, middle)
    psm_head, psm_rest = split(F.substring_index(inner, prefix, -1), suffix)
    spm_rest, spm_head = split(F.substring_index(inner, suffix, -1), prefix)
    return (
        F.when(form == "psm", F.concat(psm_head, tail, psm_rest))
        .when(form == "spm", F.concat(spm_head, tail, spm_rest))
        .otherwise(output)
    )
