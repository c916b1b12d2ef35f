"""From raw documents to packed sequences: the stages in order, each over the whole of its input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from delayflow.llm import decontamination, packing, pseudonyms, rules, simhash
from delayflow.workspace import materialize

# Pieces in one sequence: a mask of that many blocks at most.
SEQUENCE_DOCUMENTS = 16


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and every learned rule."""
    return rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near fingerprints: three-word shingles, at most two bits apart."""
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontamination.drop_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal values under pseudonyms."""
    return pseudonyms.pseudonymise(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their places in sequences of a bounded number of documents."""
    return packing.best_fit(packing.token_pieces(docs), documents=SEQUENCE_DOCUMENTS)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pseudonymise", pseudonymise),
    ("pack", pack),
]

# The rules are learned and the fingerprints hashed; SQL cannot say either.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
