"""Full-text search over a stored inverted index, scored by relevance.

The index is three tables: documents by number, terms with the number of documents they occur in, and
postings, one row per word, field and document. Terms and postings are laid out by word, so a
search reads those of its own words alone, however large the index is. A word that is in
every document has as many postings as others have together; they are rows, spread over
files and scored where they are, never gathered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delayflow.functions.text import words
from delayflow.operators.ordering import ordered_table
from delayflow.schemas import AIRPLANES_PER_PAGE
from delayflow.sources.writers import write_clustered

# Parameters of the score, and digits it is compared in.
SATURATION, LENGTH_WEIGHT = 1.2, 0.75
SCORE_DIGITS = 6

# Words of a query, beyond which it is refused.
QUERY_WORDS = 256


def build_index(df: DataFrame, path: str, fields: Sequence[str]) -> None:
    """Replace the index at ``path`` by one over ``fields`` of the rows, all columns kept with it.

    Rows are numbered in a total order. A NULL field has no words.
    """
    order = [F.col(c).asc_nulls_first() for c in df.columns]
    numbered = ordered_table(df, order, "numbered")
    write_clustered(numbered, f"{path}/documents", ["_id"], [])
    texts = F.array(*[F.struct(F.lit(f).alias("field"), words(F.col(f)).alias("found")) for f in fields])
    each = numbered.select("_id", F.explode(texts).alias("t")).select(
        "_id", "t.field", F.size("t.found").alias("length"), F.explode("t.found").alias("word")
    )
    postings = each.groupBy("word", "field", "_id", "length").agg(F.count("*").alias("times"))
    write_clustered(postings, f"{path}/postings", ["word", "field", "_id"], ["word"])
    spark = df.sparkSession
    terms = spark.read.parquet(f"{path}/postings").groupBy("word", "field").agg(F.count("*").alias("documents"))
    write_clustered(terms, f"{path}/terms", ["word", "field"], ["word"])
    # One row per field: rows of the table, and the mean length of those that have words.
    long = spark.read.parquet(f"{path}/postings").groupBy("field").agg(
        F.sum("times").alias("words"), F.count_distinct("_id").alias("filled")
    )
    long.write.mode("overwrite").parquet(f"{path}/fields")


def _scores(spark: SparkSession, path: str, asked: Sequence[tuple[str, str]]) -> DataFrame:
    """Columns _id, score and matched (fields) of each document with a word asked for."""
    wanted = reduce(lambda a, b: a | b, [(F.col("word") == w) & (F.col("field") == f) for f, w in asked])
    near = F.col("word").isin(sorted({w for _, w in asked}))
    # A row per word of the query at most, and one per field.
    terms = spark.read.parquet(f"{path}/terms").filter(near & wanted)
    fields = spark.read.parquet(f"{path}/fields")
    weights = terms.join(F.broadcast(fields), "field").select(
        "word", "field", (F.col("words") / F.col("filled")).alias("mean"),
        F.log(1 + (F.col("filled") - F.col("documents") + 0.5) / (F.col("documents") + 0.5)).alias("rarity"),
    )
    found = spark.read.parquet(f"{path}/postings").filter(near & wanted)
    scored = found.join(F.broadcast(weights), ["word", "field"])
    shortness = 1 - LENGTH_WEIGHT + LENGTH_WEIGHT * F.col("length") / F.col("mean")
    part = F.col("rarity") * F.col("times") * (SATURATION + 1) / (F.col("times") + SATURATION * shortness)
    return scored.groupBy("_id").agg(
        F.round(F.sum(part), SCORE_DIGITS).alias("score"), F.count_distinct("field").alias("matched")
    )


def query_words(spark: SparkSession, terms: Mapping[str, str | None]) -> list[tuple[str, str]]:
    """Fields and distinct words of a query; absent or empty terms ask for nothing."""
    given = {f: t for f, t in terms.items() if t}
    if not given:
        return []
    row = spark.range(1).select(*[F.array_distinct(words(F.lit(t))).alias(f) for f, t in given.items()]).first()
    asked = [(f, w) for f in given for w in row[f]]
    if len(asked) > QUERY_WORDS:
        raise ValueError(f"a query has at most {QUERY_WORDS} words")
    return asked


def search_index(
    spark: SparkSession,
    path: str,
    start: int = 0,
    size: int = AIRPLANES_PER_PAGE,
    **terms: str | None,
) -> DataFrame:
    """One page of the rows that share a word with every given term, the most relevant first.

    A word counts by how rare it is, how often the field has it, and how short the field is. Rows
    of one score are ordered by their number. A term without words matches nothing, a query
    without terms everything, with score 0.
    """
    documents = spark.read.parquet(f"{path}/documents")
    given = [f for f, t in terms.items() if t]
    asked = query_words(spark, terms)
    if not given:
        return documents.orderBy("_id").offset(start).limit(size).withColumn("score", F.lit(0.0)).drop("_id")
    if {f for f, _ in asked} != set(given):
        return documents.limit(0).withColumn("score", F.lit(0.0)).drop("_id")
    hits = _scores(spark, path, asked).filter(F.col("matched") == len(given))
    # The numbers of a page are few; with them the scan skips all other rows.
    page = hits.orderBy(F.col("score").desc(), "_id").offset(start).limit(size).select("_id", "score").collect()
    scores: Column = F.create_map(*[F.lit(x) for r in page for x in (r["_id"], r["score"])]) if page else F.lit(None)
    shown = documents.filter(F.col("_id").isin([r["_id"] for r in page]))
    score = scores[F.col("_id")] if page else F.lit(0.0)
    return shown.withColumn("score", score).orderBy(F.col("score").desc(), "_id").drop("_id")


def search_hits(spark: SparkSession, path: str, **terms: str | None) -> int:
    """Number of rows a search matches."""
    given = [f for f, t in terms.items() if t]
    asked = query_words(spark, terms)
    if not given:
        return spark.read.parquet(f"{path}/documents").count()
    if {f for f, _ in asked} != set(given):
        return 0
    return _scores(spark, path, asked).filter(F.col("matched") == len(given)).count()
