"""License scan: an automaton for tags and notices, and a parser of licence expressions."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from delayflow.llm.arrow import fresh_name, slices

# The base phrases and their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Notice phrases of the method, words as they are after folding.
NOTICE_PHRASES = {
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "isc license": "isc",
    "boost software license": "bsl",
    "creative commons": "cc",
    "licensed under cc by nc": "cc-by-nc",
    "licensed under cc by": "cc-by",
    "all rights reserved": "proprietary",
    "permission is hereby granted free of charge": "mit",
}
TAG = "spdx license identifier"
# Identifier of an expression, without version, to label.
IDENTIFIERS = {
    "mit": "mit", "apache": "apache", "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl", "bsd": "bsd",
    "mpl": "mpl", "epl": "epl", "isc": "isc", "bsl": "bsl", "cc-by": "cc-by",
    "cc-by-nc": "cc-by-nc", "cc-by-sa": "cc-by-sa", "cc-by-nc-sa": "cc-by-nc",
    "cc-by-nd": "cc-by-nd", "cc0": "cc0", "unlicense": "unlicense",
}
# How freely a text under a label may be used, from 0 to 1.
OPENNESS = {
    "mit": 1.0, "apache": 1.0, "bsd": 1.0, "isc": 1.0, "bsl": 1.0, "cc0": 1.0, "unlicense": 1.0,
    "cc-by": 0.9, "cc": 0.6, "mpl": 0.7, "epl": 0.7, "lgpl": 0.6, "cc-by-sa": 0.6, "gpl": 0.4,
    "agpl": 0.3, "cc-by-nd": 0.2, "cc-by-nc": 0.1, "proprietary": 0.0,
}
UNKNOWN = 0.5
PRECEDENCE = {"or": 1, "and": 2, "with": 3}

FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)
# White space is spelt out: a tag's expression ends with its line.
_TAGGED = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)", re.IGNORECASE)
# A slash between licences is an older way to write a choice; a comment's end is none.
_TOKEN = re.compile(r"[()]|(?<!\*)/|[A-Za-z0-9.+:-]+")
_COMMENT_END = re.compile(r"\s*(?:\*+/|-->|#}|\*\))\s*$")
# What looks like an identifier: with a capital, a digit or a hyphen, as ordinary words seldom are.
_IDENTIFIER = re.compile(r"(?=.*[A-Z0-9-])(?=.*[A-Za-z])[A-Za-z0-9][A-Za-z0-9.+-]*")


@functools.lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """All phrases between spaces, so that they match whole words only."""
    built = ahocorasick.Automaton()
    for phrase in {*BASE_PHRASES, *NOTICE_PHRASES, TAG}:
        built.add_word(f" {phrase} ", phrase)
    built.make_automaton()
    return built


def label_of(identifier: str) -> str | None:
    """Label of one licence identifier, its version and suffixes left out.

    Identifiers that are not listed are labels themselves, so every one of the public list has one.
    """
    bare = re.sub(r"(-only|-or-later|\+)$", "", identifier)
    name = bare.lower()
    while name:
        if name in IDENTIFIERS:
            return IDENTIFIERS[name]
        name = name.rpartition("-")[0]
    if not _IDENTIFIER.fullmatch(bare):
        return None
    return re.sub(r"-v?[0-9].*$", "", bare.lower())


def to_postfix(expression: str) -> list[str] | None:
    """Operands and operators in postfix order, or None if no beginning is well-formed.

    ``with`` binds before ``and``, ``and`` before ``or``, for which a slash stands too;
    parentheses group. The longest well-formed beginning counts where words follow that are no
    part of an expression, or where it breaks off.
    """
    tokens = ["or" if t == "/" else t for t in _TOKEN.findall(expression)]
    whole = _well_formed(tokens)
    if not whole:
        return None
    output, held = [], []
    for token in tokens[:whole]:
        word = token.lower()
        if word in PRECEDENCE:
            while held and held[-1] != "(" and PRECEDENCE[held[-1]] >= PRECEDENCE[word]:
                output.append(held.pop())
            held.append(word)
        elif word == "(":
            held.append(word)
        elif word == ")":
            while held[-1] != "(":
                output.append(held.pop())
            held.pop()
        else:
            output.append(token)
    return output + held[::-1]


def _well_formed(tokens: list[str]) -> int:
    """Number of tokens of the longest beginning that is an expression."""
    depth, operand_next, whole = 0, True, 0
    for place, token in enumerate(tokens, 1):
        word = token.lower()
        if operand_next != (word == "(" or word not in PRECEDENCE and word != ")"):
            break
        if word == "(":
            depth += 1
        elif word == ")":
            depth -= 1
            if depth < 0:
                break
        else:
            operand_next = word in PRECEDENCE
        if not operand_next and not depth:
            whole = place
    return whole


def evaluate(expression: str) -> tuple[set[str], float] | None:
    """Labels of an expression and its openness, or None if nothing in it is known.

    A choice is as open as its most open part, a conjunction as its least open one. An
    exception keeps the licence it is attached to.
    """
    postfix = to_postfix(expression)
    if not postfix:
        return None
    stack: list[tuple[set[str], float]] = []
    for token in postfix:
        if token.lower() not in PRECEDENCE:
            label = label_of(token)
            stack.append(({label} if label else set(), OPENNESS.get(label, UNKNOWN)))
            continue
        (right, r), (left, l) = stack.pop(), stack.pop()
        if token.lower() == "with":
            stack.append((left, l))
        else:
            stack.append((left | right, max(l, r) if token.lower() == "or" else min(l, r)))
    labels, openness = stack[0]
    return (labels, openness) if labels else None


def scan_text(text: str | None) -> dict:
    """Words, base places, labels and score of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()
    joined = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
    base, starts, notices, tagged = 0, [], [], False
    base_labels: set[str] = set()
    for end, phrase in automaton().iter(joined):
        if phrase == TAG:
            tagged = True
        elif phrase in BASE_PHRASES:
            base += 1
            base_labels.add(BASE_PHRASES[phrase])
            starts.append(end - len(phrase) - 1)
        else:
            notices.append((end - len(phrase), -end, phrase))
    found, covered = set(), 0
    # A notice inside a longer one is not meant by itself.
    for _, end, phrase in sorted(notices):
        if -end > covered:
            found.add(NOTICE_PHRASES[phrase])
            covered = -end
    scores = []
    expressions = []
    if tagged:
        for match in _TAGGED.finditer(text):
            value = evaluate(match[1])
            if value:
                expressions.append(_COMMENT_END.sub("", match[1]).strip())
                found |= value[0]
                scores.append(value[1])
    # The place of a word is the number of spaces before it.
    first = joined.count(" ", 0, starts[0]) if starts else None
    last = first + joined.count(" ", starts[0], starts[-1]) if starts else None
    labels = base_labels | found
    if not scores and labels:
        scores = [min(OPENNESS.get(label, UNKNOWN) for label in labels)]
    return {
        "n_words": len(words),
        "n_base": base,
        "first_word": first,
        "last_word": last,
        "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(labels)),
        "score": min(scores) if scores else UNKNOWN,
        "expressions": expressions,
    }


FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.StringType()),
        T.StructField("labels", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("expressions", T.ArrayType(T.StringType())),
    ]
)
_ARROW = pa.struct(
    [(n, pa.int64()) for n in ("n_words", "n_base", "first_word", "last_word")]
    + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
    + [("expressions", pa.list_(pa.string()))]
)


def scan_licenses(docs: DataFrame, text_col: str = "text", found_col: str = "license") -> DataFrame:
    """Add a struct of what the scan of each whole text finds; no shuffle, one pass.

    ``score`` is the openness, 0 to 1, of a tag's expression or else of the strictest label;
    0.5 where nothing is found. A NULL or empty text has no words, no places and empty labels.
    Repeated rows are scanned alike; other columns are kept, also if they have the names
    used here, which stand inside the struct.
    """
    name = fresh_name(docs, found_col)
    at = docs.columns.index(text_col)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [scan_text(t) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rows, _ARROW)], names=[*batch.schema.names, name]
            )

    return docs.mapInArrow(scan, T.StructType([*docs.schema.fields, T.StructField(name, FOUND)]))
