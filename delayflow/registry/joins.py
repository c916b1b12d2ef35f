"""Queries for joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayflow.operators import joins as J
from delayflow.operators.summaries import airplanes_per_carrier
from delayflow.registry import query
from delayflow.registry.tables import distances, flights, view


@query(
    "enrich_distance",
    """SELECT r.*, CAST(coalesce(d.Distance, 0) AS INT) AS Distance
    FROM requests r LEFT JOIN distances d ON r.Origin = d.Origin AND r.Dest = d.Dest""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.enrich_distance(view(spark, sf_dir, "requests"), distances(spark, sf_dir))


@query(
    "unmatched_routes",
    """SELECT r.* FROM requests r WHERE NOT EXISTS
    (SELECT 1 FROM distances d WHERE r.Origin = d.Origin AND r.Dest = d.Dest)""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.unmatched_routes(view(spark, sf_dir, "requests"), distances(spark, sf_dir))


@query(
    "correlate_request_response",
    """SELECT r.*, p.Prediction, p.answered, CASE WHEN p.UUID IS NULL THEN 'WAIT' ELSE 'OK' END AS status
    FROM requests r LEFT JOIN (SELECT UUID, arg_min(Prediction, answered) AS Prediction,
      min(answered) AS answered FROM answers GROUP BY UUID) p ON r.UUID = p.UUID""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests, answers = view(spark, sf_dir, "requests"), view(spark, sf_dir, "answers")
    return J.correlate_request_response(requests, answers, "answered")


@query(
    "airline_profile",
    """WITH fleet AS (SELECT DISTINCT Carrier, TailNum FROM flights),
    counted AS (SELECT *, count(TailNum) OVER (PARTITION BY Carrier) AS FleetCount FROM fleet)
    SELECT coalesce(a.CarrierCode, f.Carrier) AS CarrierCode, a.Name, a.url, a.domain, a.logo_url,
      a.summary, coalesce(f.FleetCount, 0) AS FleetCount, f.TailNum
    FROM airlines a FULL JOIN (SELECT * FROM counted WHERE TailNum IS NOT NULL OR FleetCount = 0) f
      ON a.CarrierCode = f.Carrier""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = J.airline_profile(
        view(spark, sf_dir, "airlines"), airplanes_per_carrier(flights(spark, sf_dir))
    )
    flat = profile.withColumn("TailNum", F.explode_outer("TailNumbers")).drop("TailNumbers", "Part")
    return flat.withColumn("FleetCount", F.coalesce("FleetCount", F.lit(0)))
