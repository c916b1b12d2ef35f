"""Joins of requests, dimensions and responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayflow.functions.values import default_if_missing
from delayflow.workspace import materialize, measured_bytes, new_path

# Largest dimension that is copied to every executor.
BROADCAST_BYTES = 32 * 1024 * 1024


def join_dimension(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join facts to a dimension that has one row per key.

    The dimension is stored once and measured. Within ``broadcast_bytes`` it is
    broadcast and the facts are not shuffled. Beyond it both sides are shuffled on
    the key; as the stored dimension is a plain scan, adaptive execution can split
    the partitions of hot keys on the facts side.
    """
    path = new_path(dim.sparkSession, "dimension")
    stored = materialize(dim, "dimension", path)
    if measured_bytes(stored, path) <= broadcast_bytes:
        stored = F.broadcast(stored)
    return facts.join(stored, list(on), how)


def key_distances(routes: DataFrame) -> DataFrame:
    """One distance per pair of airports, the greatest, in whole units."""
    return routes.groupBy("Origin", "Dest").agg(
        F.max("Distance").cast("int").alias("Distance")
    )


def enrich_distance(
    requests: DataFrame, dim: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Add ``Distance`` of the pair of airports, 0 where the pair is unknown."""
    joined = join_dimension(
        requests.drop("Distance"), key_distances(dim), ["Origin", "Dest"], "left", broadcast_bytes
    )
    return joined.withColumn("Distance", default_if_missing(F.col("Distance"), 0))


def unmatched_routes(
    requests: DataFrame, dim: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Requests whose pair of airports has no distance."""
    pairs = dim.select("Origin", "Dest").distinct()
    return join_dimension(requests, pairs, ["Origin", "Dest"], "left_anti", broadcast_bytes)


def first_responses(responses: DataFrame, moment: str = "Timestamp") -> DataFrame:
    """One response per UUID, the first in time; aggregated before the shuffle.

    Responses of one moment, without a moment (they come after those that have one), or of a
    table without that column are ordered by their other fields.
    """
    keyed = responses.filter(F.col("UUID").isNotNull()).groupBy("UUID")
    rest = [c for c in responses.columns if c != "UUID"]
    if moment in rest:
        rest = [moment, *(c for c in rest if c != moment)]
        timed = F.min(F.struct(F.col(moment).isNull().alias("_untimed"), *rest)).alias("first")
        return keyed.agg(timed).select("UUID", "first.*").select(*responses.columns)
    if len(rest) == 1:
        return keyed.agg(F.min(rest[0]).alias(rest[0]))
    return keyed.agg(F.min(F.struct(*rest)).alias("first")).select("UUID", "first.*")


def correlate_request_response(
    requests: DataFrame, responses: DataFrame, moment: str = "Timestamp"
) -> DataFrame:
    """Each request with its response and a status, WAIT where none has come.

    Responses are reduced to one per UUID and stored, so the join reads two plain
    scans and adaptive execution can split a partition swollen by one UUID, or by
    requests without any.
    """
    answers = materialize(first_responses(responses, moment).withColumn("status", F.lit("OK")), "responses")
    joined = requests.join(answers, "UUID", "left")
    return joined.withColumn("status", F.coalesce("status", F.lit("WAIT")))


def airline_profile(airlines: DataFrame, fleet: DataFrame) -> DataFrame:
    """Airline descriptions with their fleets; either side may be absent."""
    joined = airlines.join(fleet, airlines["CarrierCode"] == fleet["Carrier"], "full")
    code = F.coalesce(airlines["CarrierCode"], fleet["Carrier"])
    rest = [airlines[c] for c in airlines.columns if c != "CarrierCode"]
    rest += [fleet[c] for c in fleet.columns if c != "Carrier"]
    return joined.select(code.alias("CarrierCode"), *rest)
