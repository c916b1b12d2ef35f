"""Quality rules: text statistics, and decision lists learned from labelled ones.

Only DataFrame functions are used, in the statistics as in the learning.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayflow.workspace import materialize

# White space between words, and the characters that count as symbols.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Labelled rows that the rules are learned from, at most; chosen by a hash of the id.
SAMPLE_ROWS = 20_000
THRESHOLDS = 24
MAX_RULES = 8
MAX_CONDITIONS = 3
# A rule has to be right on so large a share of what it covers among the rows it is pruned on.
MIN_PRECISION = 0.7
MIN_COVERED = 5

NAMES = ["symbols", "marks", "capitals", "repeats", "dup_lines", "word_length", "words"]


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """A struct ``row`` of all columns, and a struct ``_stats`` of the counts of each whole text.

    The steps are kept apart so that each array is made once. Sorting finds repeated windows:
    equal ones stand side by side. NULL and empty texts count zero.
    """
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    docs = docs.select(own, F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    text = F.col("text")
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    split = docs.select(
        "row",
        words.alias("_words"),
        lines.alias("_lines"),
        F.regexp_count(text, F.lit(SYMBOLS)).alias("_symbols"),
        F.regexp_count(text, F.lit("[!?]")).alias("_marks"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).alias("_capitals"),
    )
    word = F.col("_words")
    windows = F.when(
        F.size(word) >= WINDOW,
        F.transform(
            F.sequence(F.lit(1), F.size(word) - (WINDOW - 1)),
            lambda i: F.concat_ws(" ", *[F.element_at(word, i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<string>"))
    shingled = split.select("*", windows.alias("_windows"))
    window = F.col("_windows")
    # Nothing is sorted where no window occurs twice.
    ordered = F.when(
        F.size(window) > F.size(F.array_distinct(window)),
        F.sort_array(F.transform(window, lambda w, i: F.struct(w.alias("w"), i.alias("i")))),
    )
    ranked = shingled.select("*", ordered.alias("_ordered"))
    row, last = F.col("_ordered"), F.size("_ordered")

    def same(a: Column, b: Column) -> Column:
        return F.element_at(row, a)["w"] == F.element_at(row, b)["w"]

    again = F.filter(
        F.sequence(F.lit(1), last),
        lambda i: F.when(i > 1, same(F.greatest(i - 1, F.lit(1)), i)).otherwise(False)
        | F.when(i < last, same(F.least(i + 1, last), i)).otherwise(False),
    )
    places = F.flatten(
        F.transform(again, lambda i: F.sequence(*(F.element_at(row, i)["i"] + k for k in (0, WINDOW - 1))))
    )
    repeated = F.when(row.isNotNull(), F.size(F.array_distinct(places))).otherwise(0)
    stats = F.struct(
        F.size(word).cast("long").alias("n_words"),
        F.length(F.array_join(word, "")).cast("long").alias("word_chars"),
        F.col("_symbols").cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated.cast("long").alias("n_repeat_words"),
        F.col("_marks").cast("long").alias("n_marks"),
        F.col("_capitals").cast("long").alias("n_capitals"),
    )
    # A generator is a step that no filter on the counts is moved across, with all they
    # are made of written out once more for each use.
    return ranked.select("row", F.explode(F.array(stats)).alias("_stats"))


def base_failed(stats: str = "_stats") -> Column:
    """The fixed rule: too few words, or most of them in repeated windows."""
    s = F.col(stats)
    return (s["n_words"] < MIN_WORDS) | (
        100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"]
    )


@dataclass(frozen=True)
class Condition:
    """One threshold: a feature at least, or below, a value."""

    feature: str
    at_least: bool
    value: float

    def column(self) -> Column:
        x = F.col(f"_features.{self.feature}")
        return x >= self.value if self.at_least else x < self.value

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.value:.6g}"


Rule = tuple[Condition, ...]


def _holds(rule: Rule) -> Column:
    out = F.lit(True)
    for condition in rule:
        out = out & condition.column()
    return out


def _features(stats: str = "_stats") -> Column:
    """The features of a struct of statistics."""
    s = F.col(stats)
    size, chars = F.greatest(s["n_words"], F.lit(1)), F.greatest(s["word_chars"], F.lit(1))
    return F.struct(
        (s["n_symbols"] / size).alias("symbols"),
        (s["n_marks"] / size).alias("marks"),
        (s["n_capitals"] / chars).alias("capitals"),
        (s["n_repeat_words"] / size).alias("repeats"),
        (s["n_dup_lines"] / size).alias("dup_lines"),
        (s["word_chars"] / size).alias("word_length"),
        s["n_words"].cast("double").alias("words"),
    )


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Statistics of up to ``rows`` labelled documents that pass the base rule, with ``_bad`` and ``_grow``.

    An id's label is the least one it is given; NULL ids and labels teach nothing. The ids
    are the first by a hash, so the choice is the same each time and leans to no source.
    Whether a row is for growing or pruning rules follows from its hash too.
    """
    ids = (
        labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label_col}`").alias("_label"))
        .dropna()
        .groupBy("_id")
        .agg(F.min("_label").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(rows)
    )
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    # At most ``rows`` ids are copied to the executors.
    chosen = texts.join(F.broadcast(ids), "_id")
    # What the base rule rejects is decided; rules are learned for the rest.
    measured = with_statistics(chosen, "_text").filter(~base_failed()).select(
        (F.col("row._label") == 0).alias("_bad"),
        (F.pmod(F.xxhash64(F.lit("fold"), "row._id"), F.lit(3)) < 2).alias("_grow"),
        _features().alias("_features"),
    )
    return materialize(measured, "labelled")


def binned(sample: DataFrame) -> tuple[DataFrame, dict[str, list[float]]]:
    """The sample as places among thresholds, and the thresholds of each feature.

    Thresholds are the least value and quantiles, of all growing rows and of the bad ones. The place of a value
    is the number of thresholds that it reaches.
    """
    at = [i / THRESHOLDS for i in range(THRESHOLDS)]
    both = []
    for name in NAMES:
        x = F.col(f"_features.{name}")
        both.append(F.percentile_approx(x, at, 10_000).alias(name))
        both.append(F.percentile_approx(F.when(F.col("_bad"), x), at, 10_000).alias(f"{name}_bad"))
    found = sample.filter("_grow").agg(*both).first()
    cuts = {n: sorted({*(found[n] or ()), *(found[f"{n}_bad"] or ())}) for n in NAMES}

    def place(name: str) -> Column:
        marks = F.array(*[F.lit(v) for v in cuts[name]]).cast("array<double>")
        return F.size(F.filter(marks, lambda v: v <= F.col(f"_features.{name}")))

    bins = F.array(*[place(n) for n in NAMES]).alias("_bins")
    return materialize(sample.select("_bad", "_grow", bins), "binned"), cuts


def _covers(rule: Rule, cuts: dict[str, list[float]]) -> Column:
    """Whether a rule holds for a binned row."""
    out = F.lit(True)
    for c in rule:
        place = F.col("_bins")[NAMES.index(c.feature)]
        reached = cuts[c.feature].index(c.value) + 1
        out = out & ((place >= reached) if c.at_least else (place < reached))
    return out


def _counts(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[Condition | None, tuple[int, int]]:
    """Bad and other rows that each condition covers, and all rows under None.

    One aggregation by feature and place, which no amount of rows makes larger.
    """
    exploded = rows.select("_bad", F.posexplode("_bins").alias("feature", "place"))
    got = exploded.groupBy("feature", "place").agg(
        F.count_if("_bad").alias("bad"), F.count_if(~F.col("_bad")).alias("other")
    ).collect()
    out: dict[Condition | None, tuple[int, int]] = {None: (0, 0)}
    for i, name in enumerate(NAMES):
        here = [r for r in got if r["feature"] == i]
        every = (sum(r["bad"] for r in here), sum(r["other"] for r in here))
        out[None] = every
        for place, value in enumerate(cuts[name], 1):
            above = [r for r in here if r["place"] >= place]
            p, n = sum(r["bad"] for r in above), sum(r["other"] for r in above)
            out[Condition(name, True, value)] = (p, n)
            out[Condition(name, False, value)] = (every[0] - p, every[1] - n)
    return out


def _gain(before: tuple[int, int], after: tuple[int, int]) -> float:
    """Information gained about the bad rows that stay covered."""
    if not after[0]:
        return 0.0
    share = [math.log2((p + 1) / (p + n + 2)) for p, n in (before, after)]
    return after[0] * (share[1] - share[0])


def learn_rules(sample: DataFrame) -> list[Rule]:
    """An ordered list of rules for bad rows, by sequential covering.

    A rule grows by the condition of greatest gain on the growing rows that no earlier rule
    covers, until it covers bad rows only or has MAX_CONDITIONS. It is then pruned to the
    beginning that is worth most on the pruning rows, (bad - other) / covered. Learning ends
    when a pruned rule is right on less than MIN_PRECISION there, or covers fewer than
    MIN_COVERED bad rows. Without labelled rows, or without bad ones, the list is empty.
    """
    rows, cuts = binned(sample)
    rules: list[Rule] = []
    covered = F.lit(False)
    for _ in range(MAX_RULES):
        left = rows.filter(~covered)
        rule: Rule = ()
        while len(rule) < MAX_CONDITIONS:
            counts = _counts(left.filter("_grow").filter(_covers(rule, cuts)), cuts)
            before = counts.pop(None)
            ranked = sorted(counts, key=lambda c: (-_gain(before, counts[c]), str(c)))
            if not ranked or _gain(before, counts[ranked[0]]) <= 0:
                break
            rule += (ranked[0],)
            if not counts[ranked[0]][1]:
                break
        if not rule:
            break
        starts = [rule[: i + 1] for i in range(len(rule))]
        sums = []
        for start in starts:
            hit = _covers(start, cuts)
            sums += [F.count_if(hit & F.col("_bad")), F.count_if(hit & ~F.col("_bad"))]
        got = left.filter("NOT _grow").agg(*sums).first()
        worth = [(got[2 * i], got[2 * i + 1]) for i in range(len(starts))]
        best = max(range(len(starts)), key=lambda i: ((worth[i][0] - worth[i][1]) / max(sum(worth[i]), 1), -i))
        bad, other = worth[best]
        if bad < MIN_COVERED or bad < MIN_PRECISION * (bad + other):
            break
        rules.append(starts[best])
        covered = covered | _covers(starts[best], cuts)
    return rules


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule, from 1, that holds for a struct ``_features``; else NULL."""
    out = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(_holds(rule), F.lit(i)).otherwise(out)
    return out


def judge(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    rows: int = SAMPLE_ROWS,
) -> tuple[DataFrame, list[Rule]]:
    """All documents as ``row``, with ``_stats``, ``_features``, ``_failed``, ``_rule`` and ``_kept``;
    and the rules.

    ``_rule`` is the number of the first learned rule that holds, or NULL. A document is kept
    if it passes the base rule and no learned one holds. NULL and empty texts fail the base
    rule; repeated rows are judged alike; other columns stay, inside ``row``. No documents give no rows.
    """
    learned = learn_rules(labelled_sample(docs, labels, id_col, text_col, label_col, rows))
    measured = with_statistics(docs, text_col)
    judged = (
        measured.withColumn("_features", _features())
        .withColumn("_failed", base_failed())
        .withColumn("_rule", verdict(learned))
        .withColumn("_kept", ~F.col("_failed") & F.col("_rule").isNull())
    )
    return judged, learned


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that are kept, with their own columns."""
    judged, _ = judge(docs, labels, **options)
    return judged.filter("_kept").select("row.*")
