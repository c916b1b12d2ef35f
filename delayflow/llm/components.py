"""Connected components by alternating stars, without gathering any neighbourhood."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayflow.operators.joins import join_dimension
from delayflow.workspace import materialize


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """Columns node and component, the least node that links reach, for linked nodes.

    Each round ties all neighbours to the least one, first those above a node, then those
    below; the number of rounds follows the logarithm of the nodes. A round keeps one row per
    link at most, takes minima with partial aggregation, and is stored in the shared folder,
    so that lost executors cost one round. Self links and NULLs count for nothing.
    """
    edges = materialize(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter((F.col(a) != F.col(b)))
        .distinct(),
        "edges",
    )
    seen = _signature(edges)
    while True:
        edges = materialize(_small_star(_large_star(edges)), "edges")
        now = _signature(edges)
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select("v", "v").distinct()
            )
        seen = now


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    return (
        join_dimension(both.filter(F.col("v") > F.col("u")), least, ["u"], "inner")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = join_dimension(edges, least, ["u"], "inner")
    moved = joined.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(joined.select("u", F.col("m").alias("v"))).distinct()


def _signature(edges: DataFrame) -> tuple:
    """Number and sums of the links; they stand still when the components are stars."""
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.sum(F.col("v").cast("decimal(20,0)"))
    ).first()
    return tuple(row)
