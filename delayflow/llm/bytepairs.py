"""Byte-level byte-pair encoding with the ranks of a given vocabulary, and decoding.

The distinct words of a block of documents are merged together, each step the same for all of them,
in arrays of numbers of pieces. Words that are frequent in the whole table, counted by Spark, are
merged once and copied to the tasks, a number with a bound; the others once per block. So no row of the
table is shuffled, no copied data grows with it, and Spark holds documents one by one.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delayflow.llm.arrow import fresh_name, slices
from delayflow.workspace import materialize

# Rank of what is no piece.
NO_MERGE = (1 << 31) - 1
# Bytes of the longest word that is merged with others; each step goes over what is left of it.
# Longer ones, runs of one kind of character, are merged from a heap, with equal results.
FOLD_BYTES = 256
# Bytes of the words that are merged together; a step's arrays hold some tens of bytes for each.
MERGED_BYTES = 1 << 19
# Words that are copied to all tasks, at most, and text in a block of documents.
FREQUENT_WORDS = 1 << 20
BLOCK_BYTES = 1024 * 1024
BLOCK_ROWS = 50_000
# Text whose words are objects of Python at once.
CUT_BYTES = 1 << 18
OUT_ROWS = 500

# White space, which is ASCII alone in Java's classes unless it is written out.
WHITE = r"\t-\r\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"


def read_ranks(path: str) -> dict[bytes, int]:
    """Pieces and their ranks, which are their ids, from a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def heap_merges(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of the pieces of a word, in time that grows with the logarithm of the length."""
    if word in ranks:
        return [ranks[word]]
    pieces: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
    after = list(range(1, len(word) + 1))
    before = list(range(-1, len(word) - 1))
    heap = [(ranks[word[i : i + 2]], i, 2) for i in range(len(word) - 1) if word[i : i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        j = after[i]
        # Entries of pieces that have been joined since then are passed over.
        if pieces[i] is None or j >= len(word) or len(pieces[i]) + len(pieces[j]) != size:
            continue
        pieces[i], pieces[j], after[i] = pieces[i] + pieces[j], None, after[j]
        if after[i] < len(word):
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < len(word):
                both = pieces[a] + pieces[b]
                if both in ranks:
                    heapq.heappush(heap, (ranks[both], a, len(both)))
    return [ranks[p] for p in pieces if p is not None]


def _begins(owner: np.ndarray) -> np.ndarray:
    """Whether each place is the first of those with its owner."""
    return np.concatenate([[True], owner[1:] != owner[:-1]])[: len(owner)]


class Merges:
    """Ids of the pieces of many words at once.

    What two neighbouring pieces join to is found by their numbers: a piece of several bytes is
    entered for each way to cut it into two pieces.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        number = {piece: i for i, piece in enumerate(ranks)}
        # The last number is that of no piece.
        self.none = len(number)
        self.ids = np.array([*ranks.values(), NO_MERGE], np.int64)
        self.single = np.array([number[bytes([b])] for b in range(256)], np.int64)
        pairs, whole = [np.iinfo(np.int64).max], [self.none]
        for piece, i in number.items():
            for cut in range(1, len(piece)):
                first, second = number.get(piece[:cut]), number.get(piece[cut:])
                if first is not None and second is not None:
                    pairs.append(first * self.none + second)
                    whole.append(i)
        order = np.argsort(pairs)
        self.pairs, self.whole = np.array(pairs, np.int64)[order], np.array(whole, np.int64)[order]

    def _joined(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        wanted = first * self.none + second
        at = np.searchsorted(self.pairs, wanted)
        return np.where(self.pairs[at] == wanted, self.whole[at], self.none)

    def _folded(self, owner: np.ndarray, parts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Owners and ids of the pieces of words, given by bytes, as they come to their end.

        A step joins, in each word, the two neighbours whose joined piece has the least rank, the first of equals.
        """
        both = np.full(len(parts), self.none)
        left = np.flatnonzero(owner[1:] == owner[:-1])
        both[left] = self._joined(parts[left], parts[left + 1])
        while len(parts):
            rank = self.ids[both]
            starts = np.flatnonzero(_begins(owner))
            least = np.repeat(np.minimum.reduceat(rank, starts), np.diff(starts, append=len(parts)))
            kept = least < NO_MERGE
            yield owner[~kept], self.ids[parts[~kept]]
            found = np.flatnonzero(kept & (rank == least))
            at = found[_begins(owner[found])]
            parts[at] = both[at]
            kept[at + 1] = False
            place = np.cumsum(kept)[at] - 1
            owner, parts, both = owner[kept], parts[kept], both[kept]
            both[place] = self.none
            for left in (place, place - 1):
                left = left[(left >= 0) & (left + 1 < len(parts))]
                left = left[owner[left] == owner[left + 1]]
                both[left] = self._joined(parts[left], parts[left + 1])

    def of_words(self, words: pa.Array) -> pa.ListArray:
        """The ids of each word; a word that is a piece itself is that one."""
        raw = words.cast(pa.binary()).to_pylist()
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        own = np.fromiter((self.ranks.get(w, NO_MERGE) for w in raw), np.int64, len(raw))
        lone = np.flatnonzero(own < NO_MERGE)
        some = np.flatnonzero((own == NO_MERGE) & (sizes <= FOLD_BYTES))
        found = [(lone, own[lone])]
        for i in np.flatnonzero((own == NO_MERGE) & (sizes > FOLD_BYTES)).tolist():
            ids = np.array(heap_merges(raw[i], self.ranks), np.int64)
            found.append((np.full(len(ids), i), ids))
        for group in np.split(some, np.flatnonzero(np.diff(np.cumsum(sizes[some]) // MERGED_BYTES)) + 1):
            data = np.frombuffer(b"".join([raw[i] for i in group.tolist()]), np.uint8)
            found += self._folded(np.repeat(group, sizes[group]), self.single[data])
        owner = np.concatenate([o for o, _ in found])
        ids = np.concatenate([i for _, i in found])[np.argsort(owner, kind="stable")]
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(raw)))])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))


def java_pattern(pattern: str) -> str:
    """The same pattern for Java, where no class of white space is within another one but as ``\\s``."""
    out, inside = [], False
    for token in regex.findall(r"\\.|.", pattern):
        inside = (inside or token == "[") and token != "]"
        if token == r"\s":
            token = WHITE if inside else f"[{WHITE}]"
        elif token == r"\S":
            token = f"[^{WHITE}]"
        out.append(token)
    return "".join(out)


def words_of(text: Column, pattern: str) -> Column:
    """Matches of the pattern in a text; NULL if it has characters that this Java does not know.

    Those may be letters to the pattern's own library, which cuts the texts that are encoded.
    """
    found = F.regexp_extract_all(text, F.lit(java_pattern(pattern)), F.lit(0))
    return F.when(~text.rlike(r"\p{Cn}"), found)


def frequent_words(docs: DataFrame, text_col: str, pattern: str, most: int) -> DataFrame:
    """Column word: the words of the whole table that are most frequent, ``most`` at most.

    All words are counted, before the shuffle too. A histogram of the counts, of some hundreds of
    rows, tells from which count on there are few enough. It decides only where a word is
    merged, never its ids.
    """
    found = docs.select(F.explode(words_of(F.col(f"`{text_col}`"), pattern)).alias("word"))
    short = found.filter(F.octet_length("word") <= FOLD_BYTES)
    level = F.floor(F.log2("n") * 8).cast("int").alias("level")
    counts = short.groupBy("word").agg(F.count("*").alias("n")).filter("n > 1")
    stored = materialize(counts.select("word", level), "word-counts")
    least, held = 1 << 30, 0
    for row in sorted(stored.groupBy("level").agg(F.count("*").alias("n")).collect(), reverse=True):
        held += row["n"]
        if held > most:
            break
        least = row["level"]
    return stored.filter(F.col("level") >= least).select("word")


def _cut(texts: pa.Array, matches) -> pa.ListArray:
    """Words of each text, none of NULL; those of few texts at a time are objects of Python."""
    few = slices(iter([pa.RecordBatch.from_arrays([texts], names=["text"])]), size=CUT_BYTES)
    lists = ([matches(t or "") for t in batch.column(0).to_pylist()] for batch in few)
    return pa.concat_arrays([pa.array(words, pa.list_(pa.string())) for words in lists])


class Lexicon:
    """Places of words in an array: found by their hashes in order, told by the words themselves."""

    def __init__(self, words: pa.Array) -> None:
        self.words = words
        hashes = self._hashes(words)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]

    @staticmethod
    def _hashes(words: pa.Array) -> np.ndarray:
        digest = xxhash.xxh3_64_intdigest
        return np.fromiter(map(digest, words.cast(pa.binary()).to_pylist()), np.uint64, len(words))

    def places(self, wanted: pa.Array) -> np.ndarray:
        """Place of each word, -1 for those that are not there; words with equal hashes but the first are not."""
        if not len(self.words) or not len(wanted):
            return np.full(len(wanted), -1, np.int32)
        hashes = self._hashes(wanted)
        near = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        place = self.order[near].astype(np.int32)
        same = np.asarray(pc.equal(self.words.take(pa.array(place)), wanted))
        return np.where(same, place, np.int32(-1))


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    text_col: str = "text",
    out_col: str = "ids",
    most: int = FREQUENT_WORDS,
    block_bytes: int = BLOCK_BYTES,
    decoded_col: str | None = None,
    packed_col: str | None = None,
) -> DataFrame:
    """All rows and columns, and last the array of token ids of the text.

    With ``decoded_col`` and ``packed_col`` the bytes that the ids decode to and the packed ids
    follow, as ``decode`` gives them, without another pass over the rows.

    Each match of ``pattern`` is merged for itself; text that looks like a special token is
    ordinary. NULL and empty texts have no ids; equal rows have equal ids; the column's name is
    made longer if a column has it; no documents give no rows. Texts and words of any
    length are encoded whole.
    """
    spark = docs.sparkSession
    single = set(range(256)) - {p[0] for p in ranks if len(p) == 1}
    if single:
        raise ValueError(f"bytes without rank: {sorted(single)}")
    merges = spark.sparkContext.broadcast(Merges(ranks))
    numbers = T.ArrayType(T.IntegerType())

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BLOCK_ROWS, block_bytes):
            words = batch.column(0)
            yield pa.RecordBatch.from_arrays([words, merges.value.of_words(words)], names=["word", "ids"])

    head = frequent_words(docs, text_col, pattern, most)
    # The bound on words, and that on the bytes of each, bound what is copied to the tasks.
    known = head.mapInArrow(merged, T.StructType([head.schema["word"], T.StructField("ids", numbers)])).toArrow()
    lexicon = spark.sparkContext.broadcast(Lexicon(_whole(known["word"])))
    frequent = spark.sparkContext.broadcast(_whole(known["ids"]))
    pieces_of = spark.sparkContext.broadcast(_pieces(ranks) if decoded_col else [])

    name = fresh_name(docs, out_col)
    bytes_names = [fresh_name(docs, c) for c in (decoded_col, packed_col) if c]
    # Words go along with no row: with them a batch on its way to Python would be thrice as large.
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    place = docs.columns.index(text_col)
    given = [T.StructField(n, T.BinaryType()) for n in bytes_names]
    schema = T.StructType([row.schema["row"], T.StructField(name, numbers), *given])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(pattern)
        # Of patterns with groups, whole matches are words too.
        matches = (lambda t: [m[0] for m in compiled.finditer(t)]) if compiled.groups else compiled.findall
        texts = pa.array(pieces_of.value, pa.binary())
        for batch in slices(batches, BLOCK_ROWS, block_bytes):
            rows = batch.column(0)
            words = _cut(rows.field(place), matches)
            coded = words.flatten().dictionary_encode()
            # The ids of the block's own words: first those that are frequent, then the rare.
            common = lexicon.value.places(coded.dictionary)
            rare = common < 0
            at = np.where(rare, (~rare).sum() + np.cumsum(rare), np.cumsum(~rare)) - 1
            own = merges.value.of_words(coded.dictionary.filter(pa.array(rare)))
            ids = pa.concat_arrays([frequent.value.take(pa.array(common[~rare])).cast(own.type), own])
            taken = ids.take(pa.array(at[np.asarray(coded.indices)]))
            ends = np.concatenate([[0], np.cumsum(np.asarray(taken.value_lengths()))])
            each = np.concatenate([[0], np.cumsum(np.asarray(words.value_lengths()))])
            lists = pa.ListArray.from_arrays(pa.array(ends[each], pa.int32()), taken.flatten())
            for start in range(0, len(rows), OUT_ROWS):
                some = lists.slice(start, OUT_ROWS)
                made = [f(some) for f, c in ((lambda x: _decoded(x, texts), decoded_col), (_packed, packed_col)) if c]
                yield pa.RecordBatch.from_arrays([rows.slice(start, OUT_ROWS), some, *made], names=schema.names)

    return row.mapInArrow(run, schema).select("row.*", name, *bytes_names)


def _pieces(ranks: dict[bytes, int]) -> list[bytes | None]:
    """Pieces by id."""
    pieces: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    return pieces


def _joined(lists: pa.ListArray, ends: np.ndarray, data: pa.Buffer, unknown: np.ndarray) -> pa.Array:
    """Binary values that lie one behind the other; NULL for lists that are, or that hold an unknown id."""
    edges = np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(lists.value_lengths(), 0)))])
    bad = np.concatenate([[0], np.cumsum(unknown)])[edges]
    valid = np.asarray(lists.is_valid()) & (bad[1:] == bad[:-1])
    offsets = ends[edges].astype(np.int32)
    mask = pa.array(valid).buffers()[1]
    return pa.Array.from_buffers(pa.binary(), len(lists), [mask, pa.py_buffer(offsets), data])


def _decoded(lists: pa.ListArray, pieces: pa.Array) -> pa.Array:
    """The pieces of each list of ids one after the other: those of all lists are one stretch of bytes."""
    ids = np.asarray(pc.fill_null(lists.flatten(), -1)).astype(np.int64)
    outside = (ids < 0) | (ids >= len(pieces))
    taken = pieces.take(pa.array(np.where(outside, 0, ids)))
    unknown = outside | np.asarray(taken.is_null())
    sizes = np.asarray(pc.fill_null(pc.binary_length(taken), 0))
    data = taken.buffers()[2] or pa.py_buffer(b"")
    return _joined(lists, np.concatenate([[0], np.cumsum(sizes)]), data, unknown)


def _packed(lists: pa.ListArray) -> pa.Array:
    """Ids of each list as unsigned 32-bit numbers, least byte first."""
    flat = lists.flatten()
    ids = np.asarray(pc.fill_null(flat, 0)).astype("<u4")
    return _joined(lists, 4 * np.arange(len(ids) + 1), pa.py_buffer(ids), np.asarray(flat.is_null()))


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def decode(
    rows: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids", out_col: str = "decoded", packed_col: str | None = None
) -> DataFrame:
    """All rows and columns, and the bytes of the token ids: the pieces one after the other.

    NULL if an id is not in the vocabulary or NULL, or if there are no ids at all; the
    name is made longer if a column has it. With ``packed_col`` a last column holds the ids as
    unsigned 32-bit numbers, least byte first.
    """
    shared = rows.sparkSession.sparkContext.broadcast(_pieces(ranks))
    names = [fresh_name(rows, out_col)] + ([fresh_name(rows, packed_col)] if packed_col else [])
    row = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"))
    place = rows.columns.index(ids_col)
    schema = T.StructType([row.schema["row"], *[T.StructField(n, T.BinaryType()) for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(shared.value, pa.binary())
        for batch in slices(batches):
            lists = batch.column(0).field(place)
            columns = [_decoded(lists, known), *([_packed(lists)] if packed_col else [])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["row", *names])

    return row.mapInArrow(run, schema).select("row.*", *names)
