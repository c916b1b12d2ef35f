"""Views over the test tables that stand in for flights, airplanes and requests.

One SQL text per view serves both engines; table names are replaced by DataFrames
in Spark and left as they are in the SQL twins.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayflow.functions.times import request_date_parts
from delayflow.operators.joins import enrich_distance, key_distances
from delayflow.operators.projection import (
    extract_features,
    filter_not_null_delays,
    project_features,
)
from delayflow.operators.summaries import route_avg_distance
from delayflow.sources.readers import scan_parquet
from delayflow.workspace import materialize, new_path

VIEWS = {
    "flights": """
SELECT CAST(l.l_partkey AS STRING) AS FlightNum,
  CAST(l.l_shipdate AS DATE) AS FlightDate,
  CAST(year(l.l_shipdate) AS INT) AS Year,
  CAST(month(l.l_shipdate) AS INT) AS Month,
  CAST(day(l.l_shipdate) AS STRING) AS DayofMonth,
  CAST(<weekday> AS STRING) AS DayOfWeek,
  CASE WHEN l.l_orderkey % 53 <> 0
    THEN 'C' || lpad(CAST(l.l_suppkey % 14 AS STRING), 2, '0') END AS Carrier,
  CASE WHEN l.l_suppkey % 14 <> 3 AND l.l_orderkey % 47 <> 0
    THEN 'N' || lpad(CAST(l.l_suppkey AS STRING), 5, '0') END AS TailNum,
  'A' || lpad(CAST(c.c_nationkey AS STRING), 2, '0') AS Origin,
  'A' || lpad(CAST(s.s_nationkey AS STRING), 2, '0') AS Dest,
  CAST(100 + 37 * ((c.c_nationkey * 7 + s.s_nationkey * 13) % 60) AS DOUBLE) AS Distance,
  CASE WHEN l.l_orderkey % 61 = 0 THEN NULL ELSE l.l_quantity * 1.5 - 20 END AS DepDelay,
  CASE WHEN l.l_orderkey % 50 = 0 THEN NULL
    ELSE l.l_quantity * 1.5 - 20 + (l.l_linenumber * 3 - 12) END AS ArrDelay,
  lpad(CAST(l.l_orderkey % 25 AS STRING), 2, '0')
    || lpad(CAST(l.l_partkey % 60 AS STRING), 2, '0') AS CRSDepTime,
  lpad(CAST((l.l_orderkey % 25 + l.l_linenumber) % 24 AS STRING), 2, '0')
    || lpad(CAST(l.l_partkey % 60 AS STRING), 2, '0') AS CRSArrTime,
  CASE WHEN l.l_orderkey % 61 = 0 THEN NULL
    ELSE lpad(CAST(l.l_orderkey % 24 AS STRING), 2, '0')
      || lpad(CAST(l.l_suppkey % 60 AS STRING), 2, '0') END AS DepTime,
  CASE WHEN l.l_orderkey % 50 = 0 THEN NULL
    ELSE lpad(CAST((l.l_orderkey + l.l_linenumber) % 24 AS STRING), 2, '0')
      || lpad(CAST(l.l_suppkey % 60 AS STRING), 2, '0') END AS ArrTime,
  CAST(30 + (l.l_orderkey % 300) AS DOUBLE) AS AirTime
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
""",
    "airplanes": """
SELECT 'N' || lpad(CAST(p_partkey AS STRING), 5, '0') AS TailNum,
  upper(substr(p_name, 1, 1)) || substr(p_name, 2) || ' Leasing '
    || CAST(p_partkey % 11 AS STRING) AS Owner,
  'S' || lpad(CAST(p_partkey % 50 AS STRING), 2, '0') AS OwnerState,
  p_brand AS Manufacturer, p_name AS Model,
  CAST(1970 + p_size % 50 AS INT) AS ManufacturerYear,
  CAST(p_partkey * 7 AS STRING) AS SerialNumber, p_type AS EngineManufacturer,
  'E' || CAST(p_size AS STRING) AS EngineModel
FROM {part}
""",
    "airlines": """
SELECT 'C' || lpad(CAST(n_nationkey + 2 AS STRING), 2, '0') AS CarrierCode, n_name AS Name,
  'http://www.' || lower(n_name) || '.example' AS url, lower(n_name) || '.example' AS domain,
  'http://www.' || lower(n_name) || '.example/logo.png' AS logo_url,
  'Summary of ' || n_name AS summary
FROM {nation}
""",
    "requests": """
SELECT CAST(event_id AS STRING) AS UUID,
  replace(substr(CAST(ts AS STRING), 1, 19), ' ', 'T') AS `Timestamp`,
  CAST(ts AS DATE) AS FlightDate,
  'C' || lpad(CAST(user_id % 16 AS STRING), 2, '0') AS Carrier,
  'A' || lpad(CAST(event_id % 27 AS STRING), 2, '0') AS Origin,
  'A' || lpad(CAST(user_id % 25 AS STRING), 2, '0') AS Dest,
  CAST(event_id % 2000 AS STRING) AS FlightNum, value - 40 AS DepDelay, event_type
FROM {events}
""",
    "responses": """
SELECT CAST(event_id AS STRING) AS UUID, CAST(event_id % 4 AS DOUBLE) AS Prediction
FROM {events} WHERE event_type <> 'error'
""",
    # Responses with their times; a third of the requests gets another one much later.
    "answers": """
SELECT CAST(event_id AS STRING) AS UUID, CAST(event_id % 4 AS DOUBLE) AS Prediction,
  replace(substr(CAST(ts AS STRING), 1, 17), ' ', 'T') || '59' AS answered
FROM {events} WHERE event_type <> 'error'
UNION ALL
SELECT CAST(event_id AS STRING) AS UUID, CAST(0 AS DOUBLE) AS Prediction, '2999-01-01T00:00:00' AS answered
FROM {events} WHERE event_type <> 'error' AND event_id % 3 = 0
""",
    "scored": """
SELECT FlightNum, Carrier, Origin, Dest,
  CAST(CASE WHEN ArrDelay < -15 THEN 0 WHEN ArrDelay < 0 THEN 1
    WHEN ArrDelay < 30 THEN 2 ELSE 3 END AS DOUBLE) AS label,
  CAST(CASE WHEN DepDelay < -15 THEN 0 WHEN DepDelay < 0 THEN 1
    WHEN DepDelay < 30 THEN 2 ELSE 3 END AS DOUBLE) AS Prediction
FROM {flights} WHERE ArrDelay IS NOT NULL AND DepDelay IS NOT NULL
""",
    # Written for the SQL twins only; in Spark these rows come from the operators.
    "clocks": """
SELECT *, CASE WHEN left(CRSDepTime, 2) = '24' THEN '23:59'
    ELSE left(CRSDepTime, 2) || ':' || right(CRSDepTime, 2) END AS dep_clock,
  CASE WHEN left(CRSArrTime, 2) = '24' THEN '23:59'
    ELSE left(CRSArrTime, 2) || ':' || right(CRSArrTime, 2) END AS arr_clock
FROM {flights}
""",
    "instants": """
SELECT *, CAST(CAST(FlightDate AS STRING) || ' ' || dep_clock || ':00' AS TIMESTAMP) AS dep,
  CAST(CAST(FlightDate AS STRING) || ' ' || arr_clock || ':00' AS TIMESTAMP) AS arr
FROM {clocks}
""",
    "features": """
SELECT FlightNum, FlightDate, CAST(DayOfWeek AS INT) AS DayOfWeek,
  CAST(DayofMonth AS INT) AS DayOfMonth, CAST(dayofyear(FlightDate) AS INT) AS DayOfYear,
  Carrier, Origin, Dest, Distance, DepDelay, ArrDelay, dep AS CRSDepTime,
  CASE WHEN arr < dep THEN arr + INTERVAL 1 DAY ELSE arr END AS CRSArrTime
FROM {instants} WHERE ArrDelay IS NOT NULL AND DepDelay IS NOT NULL
""",
    "routes": """
SELECT Origin, Dest, avg(Distance) AS Distance FROM {flights} GROUP BY Origin, Dest
""",
    "distances": """
SELECT Origin, Dest, CAST(trunc(Distance) AS INT) AS Distance FROM {routes}
""",
    "enriched": """
SELECT r.*, CAST(dayofyear(r.FlightDate) AS INT) AS DayOfYear,
  CAST(day(r.FlightDate) AS INT) AS DayOfMonth, CAST(isodow(r.FlightDate) AS INT) AS DayOfWeek,
  CAST(coalesce(d.Distance, 0) AS DOUBLE) AS Distance
FROM {requests} r LEFT JOIN {distances} d ON r.Origin = d.Origin AND r.Dest = d.Dest
""",
}

# Monday = 1 in either engine.
_WEEKDAY = {
    "spark": "weekday(CAST(l.l_shipdate AS DATE)) + 1",
    "sql": "isodow(CAST(l.l_shipdate AS DATE))",
}


def _needed(sql: str) -> list[str]:
    """Views a text refers to, those they refer to first."""
    found: list[str] = []
    for name in VIEWS:
        if re.search(rf"\b{name}\b", sql):
            found += [n for n in _needed(VIEWS[name]) if n not in found]
            found.append(name)
    return list(dict.fromkeys(found))


def with_views(sql: str) -> str:
    """A SQL twin with the views it needs as common table expressions."""
    parts = []
    for name in _needed(sql):
        body = re.sub(r"\{(\w+)\}", r"\1", VIEWS[name]).replace("<weekday>", _WEEKDAY["sql"])
        parts.append(f"{name} AS ({body.replace('`', chr(34)).strip()})")
    body = sql.strip()
    if not parts:
        return body
    joiner = ",\n" if body.upper().startswith("WITH ") else "\n"
    if joiner == ",\n":
        body = body[5:]
    return "WITH " + ",\n".join(parts) + joiner + body


# Near-unique key of the one large table. Its test copies are one row group, which a scan
# cannot split, so the fixture is spread by the key; the library's readers never shuffle.
_SPREAD = {"lineitem": "l_orderkey"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = scan_parquet(spark, f"{sf_dir}/{name}.parquet")
    if name in _SPREAD:
        return df.repartition(spark.sparkContext.defaultParallelism, _SPREAD[name])
    return df


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in view as a DataFrame."""
    text = VIEWS[name].replace("<weekday>", _WEEKDAY["spark"])
    inputs = {
        used: view(spark, sf_dir, used) if used in VIEWS else table(spark, sf_dir, used)
        for used in re.findall(r"\{(\w+)\}", text)
    }
    return spark.sql(text, **inputs)


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "flights")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature rows of all flights with both delays known."""
    return extract_features(filter_not_null_delays(project_features(flights(spark, sf_dir))))


def comparable(df: DataFrame) -> DataFrame:
    """Instants without a zone, as the SQL twins have them."""
    names = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names}) if names else df


_stored: dict[tuple[str, str, str], DataFrame] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A derived table that several queries start from, written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        _stored[key] = materialize(build(), name)
    return _stored[key]


def stored_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flights, written once per session: for queries that go over them several times."""
    return stored(spark, sf_dir, "flights", lambda: flights(spark, sf_dir))


_paths: dict[tuple[str, str, str], str] = {}


def stored_path(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Where a table lies that ``write`` puts at a path, once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _paths:
        path = new_path(spark, name)
        write(path)
        _paths[key] = path
    return _paths[key]


def distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance per pair of airports, from the flights."""
    return key_distances(route_avg_distance(flights(spark, sf_dir)))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests as they are published: with distance and date parts."""

    def build() -> DataFrame:
        requests = request_date_parts(view(spark, sf_dir, "requests"), monday=1)
        joined = enrich_distance(requests, distances(spark, sf_dir))
        return joined.withColumn("Distance", F.col("Distance").cast("double"))

    return stored(spark, sf_dir, "enriched", build)
