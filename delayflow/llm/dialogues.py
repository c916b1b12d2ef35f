"""Chat formatting: every dialogue from the point of view of each of its speakers.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayflow.operators.joins import join_dimension
from delayflow.operators.ordering import number_rows
from delayflow.workspace import materialize

# How a message is rendered.
OPEN, MIDDLE, CLOSE = "<|", "|>\n", "\n<|end|>\n"
SYSTEM = "system"
NOBODY = "unknown"
# Messages in one row; a longer dialogue has several rows, numbered by part.
PART_MESSAGES = 512


def perspectives(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    size: int = PART_MESSAGES,
) -> DataFrame:
    """Columns conv_id, perspective, part, first, n_messages, text, mask and messages.

    In the rows of a perspective its speaker is the assistant and all others are users with
    their names; system messages stay what they are and are no speaker's. ``mask`` lists the
    spans of the assistant's contents and their ends in ``text``, ``[start, end)`` in characters of
    this row's text. ``first`` is the place of the part's first message in its dialogue.

    Messages are numbered over all dialogues by a range sort, so a dialogue of any length is
    cut into parts of at most ``size`` messages without one task seeing it all. Ties in turn
    are ordered by role and text, repeated rows stay, NULL turns come first, NULL roles
    speak as "unknown", NULL texts are empty, NULL conversations are one dialogue. A
    dialogue of system messages alone has no speaker and no row. Other columns are not read.
    """
    speaker = F.coalesce(F.col(f"`{role}`"), F.lit(NOBODY))
    rows = turns.select(
        F.col(f"`{conversation}`").alias("conv_id"),
        F.col(f"`{turn}`").alias("turn"),
        speaker.alias("speaker"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("content"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "speaker", "content")]
    placed = materialize(
        number_rows(rows, order, "place").select("conv_id", "speaker", "content", "place"), "messages"
    )
    # NULL conversations join through the string and the mark together.
    key = [F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("_key"), F.col("conv_id").isNull().alias("_none")]
    keyed = placed.select("*", *key)
    begins = keyed.groupBy("_key", "_none").agg(F.min("place").alias("begin"))
    own = join_dimension(keyed, begins, ["_key", "_none"], "inner").withColumn(
        "at", F.col("place") - F.col("begin")
    )
    parts = (
        own.withColumn("part", F.floor(F.col("at") / size).cast("int"))
        .groupBy("_key", "_none", "part")
        .agg(
            F.first("conv_id").alias("conv_id"),
            F.sort_array(F.collect_list(F.struct("at", "speaker", "content"))).alias("said"),
        )
    )
    speakers = (
        keyed.filter(F.col("speaker") != SYSTEM).select("_key", "_none", F.col("speaker").alias("perspective")).distinct()
    )
    both = _join_all(parts, speakers)
    roles = F.transform(
        "said",
        lambda m: F.struct(
            F.when(m["speaker"] == F.col("perspective"), "assistant")
            .when(m["speaker"] == SYSTEM, SYSTEM)
            .otherwise("user")
            .alias("role"),
            m["speaker"].alias("name"),
            m["content"].alias("content"),
            (m["speaker"] == F.col("perspective")).alias("train"),
        ),
    )
    voiced = both.select("conv_id", "perspective", "part", F.col("said")[0]["at"].alias("first"), roles.alias("messages"))
    heads = F.transform(
        "messages",
        lambda m: F.concat(
            F.lit(OPEN), m["role"],
            F.when(m["role"] == "user", F.concat(F.lit(" name="), m["name"])).otherwise(""),
            F.lit(MIDDLE),
        ),
    )
    shown = voiced.select("*", heads.alias("_heads"))
    rendered = F.array_join(
        F.zip_with("_heads", "messages", lambda h, m: F.concat(h, m["content"], F.lit(CLOSE))), ""
    )
    sizes = F.zip_with(
        "_heads",
        "messages",
        lambda h, m: F.struct(
            F.length(h).cast("long").alias("head"),
            (F.length(m["content"]) + len(CLOSE)).cast("long").alias("body"),
            m["train"].alias("train"),
        ),
    )
    start = F.struct(F.lit(0).cast("long").alias("end"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))
    spans = F.aggregate(
        sizes,
        start,
        lambda s, x: F.struct(
            (s["end"] + x["head"] + x["body"]).alias("end"),
            F.when(
                x["train"],
                F.concat(
                    s["spans"],
                    F.array(
                        F.struct(
                            (s["end"] + x["head"]).alias("start"),
                            (s["end"] + x["head"] + x["body"]).alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(s["spans"])
            .alias("spans"),
        ),
        lambda s: s["spans"],
    )
    return shown.select(
        "conv_id", "perspective", "part", "first",
        F.size("messages").alias("n_messages"), rendered.alias("text"), spans.alias("mask"), "messages",
    )


def _join_all(parts: DataFrame, speakers: DataFrame) -> DataFrame:
    """Each part with every speaker of its dialogue.

    There are few parts to a dialogue, and they are stored, so that both sides are plain
    scans and a dialogue with many parts can be split.
    """
    return join_dimension(materialize(parts, "parts"), speakers, ["_key", "_none"], "inner")
