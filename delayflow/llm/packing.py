"""Best-fit packing of token pieces into sequences with several capacities."""

from __future__ import annotations

import base64
import functools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delayflow.llm.arrow import slices
from delayflow.workspace import materialize

VOCABULARY = "byte_bpe_50k.tiktoken"
END_ID = 0
SEQUENCE_TOKENS = 2048
# Pieces that a task holds and fits together; open sequences are carried to its next block.
BLOCK_PIECES = 16_384
# Bytes of a block, with all columns of its pieces; wide pieces are fitted in smaller blocks.
BLOCK_BYTES = 16 * 1024 * 1024

PLACED = [
    T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType()),
]


@functools.lru_cache(maxsize=2)
def encoder(vocabulary: str):
    """The byte-pair encoder of a vocabulary file of the public tokenizers.

    The ``tokenizers`` file and the ranks file hold the same vocabulary and give the same
    ids; the ranks are read here because their library is four times faster. Strings that
    look like special tokens are ordinary text.
    """
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(vocabulary), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def token_ids(text: str, vocabulary: str = VOCABULARY) -> np.ndarray:
    """Ids of a text and the closing id, as little-endian unsigned 32-bit numbers."""
    ids = encoder(vocabulary).encode_to_numpy(text, disallowed_special=())
    return np.append(ids, END_ID).astype("<u4")


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SEQUENCE_TOKENS,
    vocabulary: str = VOCABULARY,
    keep_ids: bool = True,
) -> DataFrame:
    """Token pieces of at most ``size`` ids: id, piece, start, length, ids_crc32 and ids.

    A text that fits is one piece. A longer one is cut so that every piece but the first
    is full, and the first holds what is left over. NULL and empty texts are the closing id alone.
    Repeated rows give repeated pieces. Other columns are not read.
    """
    kind = docs.schema[id_col].dataType
    fields = [
        T.StructField("doc_id", kind),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    if keep_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, pieces, starts, lengths, sums, kept = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                ids = token_ids(text or "", vocabulary)
                begin, end = 0, (len(ids) - 1) % size + 1
                piece = 0
                while begin < len(ids):
                    part = ids[begin:end]
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(begin)
                    lengths.append(len(part))
                    sums.append(zlib.crc32(part.tobytes()))
                    if keep_ids:
                        kept.append(part.astype(np.int32))
                    begin, end, piece = end, end + size, piece + 1
            columns = [
                batch.column(0).take(pa.array(rows, pa.int64())),
                pa.array(pieces, pa.int32()),
                pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(sums, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(cut, T.StructType(fields))


class VectorBins:
    """Open sequences as residual vectors of tokens, documents and attention cost.

    A piece may go to any sequence with room in all three. ``norm`` takes the one with the
    least weighted square norm of what would remain; ``dot`` the one with the greatest
    weighted dot product of residual and demand. Ties go to the oldest.
    """

    def __init__(self, capacity, documents, cost, weights, score):
        if score not in ("norm", "dot"):
            raise ValueError(f"unknown score: {score}")
        self.scale = np.array([capacity, documents, cost], float)
        self.weights, self.score = np.asarray(weights, float), score
        self.left = np.empty((3, 64))
        self.used = np.empty(64, np.int64)
        self.numbers = np.empty(64, np.int64)
        self.open = self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        """Sequence and offset of one piece."""
        demand = np.array([length, 1.0, float(length) ** 2])
        if (demand > self.scale).any():
            raise ValueError(f"a piece of {length} tokens is over a capacity of a sequence")
        left = self.left[:, : self.open]
        fits = np.flatnonzero(
            (left[0] >= demand[0]) & (left[1] >= demand[1]) & (left[2] >= demand[2])
        )
        if len(fits):
            room = left[:, fits] / self.scale[:, None]
            need = (demand / self.scale)[:, None]
            weights = self.weights[:, None]
            if self.score == "norm":
                best = int(fits[np.argmin((weights * (room - need) ** 2).sum(axis=0))])
            else:
                best = int(fits[np.argmax((weights * room * need).sum(axis=0))])
        else:
            best = self._new()
        offset = int(self.used[best])
        self.left[:, best] -= demand
        self.used[best] += length
        return int(self.numbers[best]), offset

    def _new(self) -> int:
        if self.open == len(self.numbers):
            self.left = np.concatenate([self.left, np.empty_like(self.left)], axis=1)
            self.used = np.concatenate([self.used, np.empty_like(self.used)])
            self.numbers = np.concatenate([self.numbers, np.empty_like(self.numbers)])
        at, self.open = self.open, self.open + 1
        self.left[:, at], self.used[at], self.numbers[at] = self.scale, 0, self.made
        self.made += 1
        return at

    def close_below(self, length: int) -> None:
        """Forget sequences that no piece of at least ``length`` can enter."""
        left = self.left[:, : self.open]
        keep = np.flatnonzero((left[0] >= length) & (left[1] >= 1) & (left[2] >= length**2))
        for values in (self.used, self.numbers):
            values[: len(keep)] = values[keep]
        self.left[:, : len(keep)] = self.left[:, keep]
        self.open = len(keep)

    def place_all(self, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of a block of pieces, longest first."""
        numbers, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        least = int(lengths.min()) if len(lengths) else 1
        for done, at in enumerate(np.argsort(-lengths, kind="stable")):
            numbers[at], offsets[at] = self.place(int(lengths[at]))
            if done % 128 == 127:
                self.close_below(least)
        self.close_below(1)
        return numbers, offsets


def best_fit(
    pieces: DataFrame,
    capacity: int = SEQUENCE_TOKENS,
    documents: int = SEQUENCE_TOKENS,
    cost: int = SEQUENCE_TOKENS**2,
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3),
    score: str = "norm",
    block: int = BLOCK_PIECES,
) -> DataFrame:
    """Give each piece a ``sequence_id`` and its ``offset`` there.

    A sequence holds at most ``capacity`` tokens, ``documents`` pieces and a sum of squared
    lengths of ``cost``. Pieces are stored once, dealt evenly to as many tasks as there are
    blocks of ``block`` pieces (at most the width of shuffles), and fitted block by block;
    what is open after a block stays open for the task's next one, so only the last sequences
    of each task are part full. Rows are ordered inside a task, so a task that runs again
    gives the same places. NULL ids, repeated and tied rows are pieces like others, and every
    other column is passed through. No pieces give no rows.
    """
    stored = materialize(pieces, "pieces")
    width = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(width, math.ceil(stored.count() / block)))
    order = [c for c in ("doc_id", "piece", "start", "length", "ids_crc32") if c in stored.columns]
    dealt = stored.repartition(tasks).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = VectorBins(capacity, documents, cost, weights, score)
        first = TaskContext.get().partitionId() << 36

        def placed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lengths = np.concatenate([np.asarray(b["length"], dtype=np.int64) for b in held])
            numbers, offsets = bins.place_all(lengths)
            at = 0
            for part in held:
                here = slice(at, at + part.num_rows)
                at += part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(numbers[here] + first), pa.array(offsets[here])],
                    names=[*part.schema.names, "sequence_id", "offset"],
                )

        held, rows = [], 0
        for batch in batches:
            at = 0
            wide = BLOCK_BYTES // max(1, batch.nbytes // max(1, batch.num_rows))
            most = max(1, min(block, wide))
            while at < batch.num_rows:
                part = batch.slice(at, max(1, most - rows))
                held.append(part)
                rows, at = rows + part.num_rows, at + part.num_rows
                if rows >= most:
                    yield from placed(held)
                    held, rows = [], 0
        if rows:
            yield from placed(held)

    return dealt.mapInArrow(pack, T.StructType(stored.schema.fields + PLACED))
