"""Ordinal regression on graded ratings: hashed text, one set of weights, ordered thresholds."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delayflow.llm.arrow import fresh_name, slices
from delayflow.llm.decontamination import fold_words
from delayflow.workspace import materialize

BUCKETS = 1 << 18
# Rated documents that the model is fitted on, at most; chosen by a hash of the id.
SAMPLE_ROWS = 8_000
# Sample documents that a bucket has to occur in to get a weight, its penalty, and the steps.
MIN_DOCUMENTS = 3
PENALTY = 4e-4
STEPS = 250
RATE = 0.3

# Characters whose share of a text is a feature in steps of powers of two.
SHARES = {
    "symbol": b"#*$%&<>", "bar": b"|", "mark": b"!?",
    "capital": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "line": b"\n",
}


def _step(part: int, whole: int) -> int:
    """Share in steps: 0 for none, then one more for each doubling from 1/256."""
    return 0 if not part else max(1, (256 * part // max(whole, 1)).bit_length())


def buckets(text: str | None) -> np.ndarray:
    """Distinct hashed features of a whole text: its words, and steps of some of its shares."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = fold_words(text)
    distinct = set(words)
    named = [f"#words={len(words).bit_length()}", f"#again={_step(len(words) - len(distinct), len(words))}"]
    named += [
        f"#{name}={_step(len(raw) - len(raw.translate(None, chars)), len(raw))}"
        for name, chars in SHARES.items()
    ]
    hashed = [zlib.crc32(w) for w in distinct]
    hashed += [zlib.crc32(w.encode()) for w in named]
    return np.unique(np.array(hashed, np.int64) % BUCKETS)


@dataclass
class OrdinalModel:
    """Weights by bucket, and thresholds in rising order; grade k is from threshold k - 1 on."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """Probability of each grade from 1 on, or a better one; a row per score."""
        return _sigmoid(np.asarray(score)[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(features: list[np.ndarray], grades: np.ndarray, levels: int) -> OrdinalModel:
    """Maximum likelihood of the cumulative logit model, with an absolute penalty on weights.

    Adaptive gradient steps over all rows, each followed by shrinking. Thresholds are kept
    apart by exponentials, so their order holds at every step.
    """
    counts = np.array([len(f) for f in features], np.int64)
    rows = np.repeat(np.arange(len(features)), counts)
    flat = np.concatenate(features) if len(features) else np.empty(0, np.int64)
    seen = np.bincount(flat, minlength=BUCKETS)
    active = np.flatnonzero(seen >= MIN_DOCUMENTS)
    column = np.full(BUCKETS, -1)
    column[active] = np.arange(len(active))
    used = column[flat] >= 0
    rows, columns = rows[used], column[flat[used]]
    total = max(len(grades), 1)
    share = np.array([np.mean(grades >= k) if len(grades) else 0.5 for k in range(1, levels)])
    share = np.clip(share, 1e-3, 1 - 1e-3)
    start = np.maximum.accumulate(-np.log(share / (1 - share)) + 1e-3 * np.arange(levels - 1))
    first, gaps = start[0], np.log(np.maximum(np.diff(start), 1e-2))
    weights = np.zeros(len(active))
    squares, own = np.full(len(active), 1e-8), np.full(levels - 1, 1e-8)
    for _ in range(STEPS if len(grades) else 0):
        thresholds = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        score = np.bincount(rows, weights[columns], minlength=len(grades))
        tails = _sigmoid(score[:, None] - thresholds)
        bounded = np.column_stack([np.ones(len(grades)), tails, np.zeros(len(grades))])
        at = np.arange(len(grades))
        upper, lower = bounded[at, grades], bounded[at, grades + 1]
        chance = np.maximum(upper - lower, 1e-9)
        by_score = (upper + lower - 1) / total
        slope = bounded * (1 - bounded)
        by_threshold = np.zeros(levels + 1)
        np.add.at(by_threshold, grades, slope[at, grades] / chance)
        np.add.at(by_threshold, grades + 1, -slope[at, grades + 1] / chance)
        moved = by_threshold[1:levels] / total
        gradient = np.bincount(columns, by_score[rows], minlength=len(active))
        squares += gradient**2
        rate = RATE / np.sqrt(squares)
        weights -= rate * gradient
        weights = np.sign(weights) * np.maximum(np.abs(weights) - rate * PENALTY, 0)
        # A later threshold moves with the first and with every gap before it.
        inner = np.append(np.sum(moved), np.exp(gaps) * np.cumsum(moved[::-1])[::-1][1:])
        own += inner**2
        change = RATE * inner / np.sqrt(own)
        first, gaps = first - change[0], gaps - change[1:]
    full = np.zeros(BUCKETS, np.float32)
    full[active] = weights
    return OrdinalModel(full, first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]))


def fit_ordinal(
    docs: DataFrame,
    ratings: DataFrame,
    grade: Column,
    levels: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows: int = SAMPLE_ROWS,
) -> OrdinalModel:
    """Fit on up to ``rows`` rated documents, the first by a hash of their id.

    ``grade`` is a column of ``ratings`` from 0, the worst, to ``levels - 1``; an id rated
    more than once counts with its least grade. NULL ids and grades teach nothing; without
    ratings the weights are zero. The bounded sample is fitted in one task; the driver gets
    the model alone, whose size is fixed.
    """
    ids = (
        ratings.select(F.col(f"`{id_col}`").alias("_id"), grade.cast("int").alias("_grade"))
        .dropna()
        .filter(F.col("_grade").between(0, levels - 1))
        .groupBy("_id")
        .agg(F.min("_grade").alias("_grade"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(rows)
    )
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    # At most ``rows`` ids are copied to the executors; of rows with one id the least text counts.
    rated = texts.join(F.broadcast(ids), "_id")
    chosen = rated.groupBy("_id").agg(F.min("_grade").alias("_grade"), F.min("_text").alias("_text")).drop("_id")
    hashed = T.StructType(
        [T.StructField("grade", T.IntegerType()), T.StructField("at", T.ArrayType(T.IntegerType()))]
    )
    model = T.StructType(
        [T.StructField("weights", T.BinaryType()), T.StructField("thresholds", T.ArrayType(T.DoubleType()))]
    )

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [buckets(t).astype(np.int32) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int32()))], names=hashed.names
            )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grades, features = [], []
        for batch in batches:
            grades += batch.column(0).to_pylist()
            lists = batch.column(1)
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            features += [values[a:b].astype(np.int64) for a, b in zip(ends[:-1], ends[1:])]
        # The order in which rows arrive must not matter.
        order = sorted(range(len(grades)), key=lambda i: (grades[i], zlib.crc32(features[i].tobytes())))
        fitted = fit([features[i] for i in order], np.array([grades[i] for i in order], np.int64), levels)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([fitted.weights.tobytes()], pa.binary()),
                pa.array([fitted.thresholds.tolist()], pa.list_(pa.float64())),
            ],
            names=model.names,
        )

    # Stored first: the search for the sample's texts is spread, only the sample meets in a task.
    sample = materialize(chosen.mapInArrow(featurise, hashed), "rated")
    row = sample.coalesce(1).mapInArrow(train, model).first()
    if row is None:
        return fit([], np.empty(0, np.int64), levels)
    return OrdinalModel(np.frombuffer(row["weights"], np.float32), np.array(row["thresholds"]))


def grade_documents(
    docs: DataFrame, model: OrdinalModel, text_col: str = "text", graded_col: str = "graded"
) -> DataFrame:
    """Add a struct of score, expected_grade and tails (probability of grade k or better, k from 1).

    One pass over whole texts with a broadcast model of fixed size; no shuffle. NULL and empty
    texts have the features of no words. Rows and other columns are kept as they are.
    """
    name = fresh_name(docs, graded_col)
    at = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(
        [
            T.StructField("score", T.DoubleType()),
            T.StructField("expected_grade", T.DoubleType()),
            T.StructField("tails", T.ArrayType(T.DoubleType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in slices(batches):
            score = np.array(
                [known.weights[buckets(t)].sum(dtype=np.float64) for t in batch.column(at).to_pylist()]
            )
            tails = known.tails(score)
            values = pa.StructArray.from_arrays(
                [
                    pa.array(score),
                    pa.array(tails.sum(axis=1)),
                    pa.array(list(tails), pa.list_(pa.float64())),
                ],
                names=schema.names,
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, schema)]))
