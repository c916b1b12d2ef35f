"""Queries for point lookups and searches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayflow.operators import lookups as L
from delayflow.operators.search import build_index, search_index
from delayflow.operators.summaries import airplanes_per_carrier
from delayflow.registry import query
from delayflow.registry.tables import distances, flights, stored_path, view
from delayflow.sources.writers import write_clustered

ALL_FLIGHT_COLUMNS = (
    "FlightNum, FlightDate, Year, Month, DayofMonth, DayOfWeek, Carrier, TailNum, Origin, Dest, "
    "Distance, DepDelay, ArrDelay, CRSDepTime, CRSArrTime, DepTime, ArrTime, AirTime"
)


def ordered(*first: str, nulls: str = "LAST") -> str:
    """SQL sort list: the given columns, then all others of a flight."""
    rest = [c.strip() for c in ALL_FLIGHT_COLUMNS.split(",") if c.strip() not in first]
    return ", ".join(f"{c} NULLS {nulls}" for c in [*first, *rest])


@query(
    "lookup_flight",
    f"""SELECT * FROM flights WHERE Carrier = 'C12' AND FlightDate = DATE '1996-12-17'
    AND FlightNum = '1632' ORDER BY {ordered(nulls="FIRST")} LIMIT 1""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.lookup_flight(flights(spark, sf_dir), "C12", "1996-12-17", "1632")


def _clustered(spark: SparkSession, sf_dir: str, name: str, order: list[str], looked_up: list[str]) -> DataFrame:
    """A view as a table laid out for point lookups, written once per session."""

    def build(path: str) -> None:
        write_clustered(view(spark, sf_dir, name), path, order, looked_up, row_group_bytes=1024 * 1024)

    return spark.read.parquet(stored_path(spark, sf_dir, f"clustered-{name}", build))


@query(
    "lookup_flight_clustered",
    f"""SELECT * FROM flights WHERE Carrier = 'C12' AND FlightDate = DATE '1996-12-17'
    AND FlightNum = '1632' ORDER BY {ordered(nulls="FIRST")} LIMIT 1""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _clustered(spark, sf_dir, "flights", ["FlightDate", "Carrier"], ["FlightNum"])
    return L.lookup_flight(table, "C12", "1996-12-17", "1632")


@query(
    "lookup_status_clustered",
    """SELECT id, CASE WHEN count(Prediction) > 0 THEN 'OK' ELSE 'WAIT' END AS status,
    arg_min(Prediction, answered) AS Prediction
    FROM (SELECT '0' AS id UNION ALL SELECT '33') LEFT JOIN answers ON UUID = id GROUP BY id""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _clustered(spark, sf_dir, "answers", ["answered"], ["UUID"])
    found = [L.lookup_prediction_status(table, uuid, "answered") for uuid in ("0", "33")]
    return found[0].unionByName(found[1])


@query(
    "list_route_flights",
    """SELECT * FROM flights WHERE Origin = 'A10' AND Dest = 'A19'
    AND FlightDate = DATE '1997-02-22'""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.list_route_flights(flights(spark, sf_dir), "A10", "A19", "1997-02-22")


PAGE = ordered("FlightDate", "DepTime", "Carrier", "FlightNum")


@query(
    "search_flights",
    f"""SELECT * FROM flights WHERE Carrier = 'C01' AND Origin = 'A19'
    ORDER BY {PAGE} LIMIT 15 OFFSET 30""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.search_flights(flights(spark, sf_dir), start=30, Carrier="C01", Origin="A19", Dest=None)


@query(
    "search_page",
    f"""WITH hits AS (SELECT * FROM flights WHERE Carrier = 'C01' AND Origin = 'A19'),
    page AS (SELECT * FROM hits ORDER BY {PAGE} LIMIT 15 OFFSET 30)
    SELECT (SELECT count(*) FROM hits) AS total, (SELECT count(*) FROM page) AS shown,
      (SELECT string_agg(FlightNum, ',' ORDER BY {PAGE}) FROM page) AS flight_nums,
      (SELECT count(*) FROM hits) > 45 AS next_shown, (SELECT count(*) FROM hits) > 15 AS previous_shown""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = L.search_page(flights(spark, sf_dir), start=30, Carrier="C01", Origin="A19")
    numbers = F.transform("flights", lambda r: r["FlightNum"])
    return page.select(
        "total", F.size("flights").cast("long").alias("shown"), F.array_join(numbers, ",").alias("flight_nums"),
        "next_shown", "previous_shown",
    )


@query(
    "search_airplanes",
    r"""WITH words AS (SELECT *,
      list_distinct(regexp_split_to_array(lower(Owner), '[^\p{L}\p{N}_]+')) AS owner_words,
      list_distinct(regexp_split_to_array(lower(Manufacturer), '[^\p{L}\p{N}_]+')) AS mfr_words
      FROM airplanes),
    hits AS (SELECT *, len(list_intersect(owner_words, ['blue', 'widget', '3'])) AS owner_hits,
      len(list_intersect(mfr_words, ['brand', '7'])) AS mfr_hits FROM words)
    SELECT TailNum, Owner, OwnerState, Manufacturer, Model, ManufacturerYear, SerialNumber,
      EngineManufacturer, EngineModel, CAST(owner_hits + mfr_hits AS INT) AS score
    FROM hits WHERE owner_hits > 0 AND mfr_hits > 0
    ORDER BY Owner, score DESC, TailNum LIMIT 5 OFFSET 10""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.search_airplanes(
        view(spark, sf_dir, "airplanes"), start=10, Owner="Blue Widget 3", Manufacturer="brand 7"
    )


_AIRPLANE = "TailNum, Owner, OwnerState, Manufacturer, Model, ManufacturerYear, SerialNumber, EngineManufacturer, EngineModel"


@query(
    "search_airplanes_relevance",
    rf"""WITH texts AS (SELECT *, 'Owner' AS field, regexp_split_to_array(lower(Owner), '[^\p{{L}}\p{{N}}_]+') AS found FROM airplanes
      UNION ALL
      SELECT *, 'Manufacturer' AS field, regexp_split_to_array(lower(Manufacturer), '[^\p{{L}}\p{{N}}_]+') AS found FROM airplanes),
    postings AS (SELECT * EXCLUDE (found), len(found) AS length, unnest(found) AS word FROM texts),
    counted AS (SELECT *, count(*) AS times FROM postings GROUP BY ALL),
    terms AS (SELECT word, field, count(*) AS documents FROM counted GROUP BY word, field),
    fields AS (SELECT field, avg(len(found)) AS mean, count(*) AS filled FROM texts GROUP BY field),
    asked(word, field) AS (VALUES ('blue', 'Owner'), ('widget', 'Owner'), ('3', 'Owner'), ('brand', 'Manufacturer'), ('7', 'Manufacturer')),
    hits AS (SELECT {_AIRPLANE},
      round(sum(ln(1 + (filled - documents + 0.5) / (documents + 0.5)) * times * 2.2
        / (times + 1.2 * (0.25 + 0.75 * length / mean))), 6) AS score
      FROM counted JOIN asked USING (word, field) JOIN terms USING (word, field) JOIN fields USING (field)
      GROUP BY {_AIRPLANE} HAVING count(DISTINCT field) = 2)
    SELECT * FROM hits ORDER BY score DESC, {_AIRPLANE} LIMIT 5 OFFSET 10""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    airplanes = view(spark, sf_dir, "airplanes")
    index = stored_path(
        spark, sf_dir, "airplane-index", lambda path: build_index(airplanes, path, ["Owner", "Manufacturer"])
    )
    return search_index(spark, index, start=10, Owner="Blue Widget 3", Manufacturer="brand 7")


@query(
    "requests_in_day",
    """SELECT * FROM requests WHERE "Timestamp" >= '2024-01-15' AND "Timestamp" <= '2024-01-16'""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.requests_in_day(view(spark, sf_dir, "requests"), "2024-01-15")


@query("lookup_distance", "SELECT Distance FROM distances WHERE Origin = 'A03' AND Dest = 'A07'")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.lookup_distance(distances(spark, sf_dir), "A03", "A07")


@query(
    "lookup_prediction_status",
    """SELECT id, CASE WHEN count(Prediction) > 0 THEN 'OK' ELSE 'WAIT' END AS status,
    arg_min(Prediction, answered) AS Prediction
    FROM (SELECT '0' AS id UNION ALL SELECT '1') LEFT JOIN answers ON UUID = id GROUP BY id""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = view(spark, sf_dir, "answers")
    waiting = L.lookup_prediction_status(answers, "0", "answered")
    return waiting.unionByName(L.lookup_prediction_status(answers, "1", "answered"))


@query("list_carriers", "SELECT DISTINCT Carrier FROM flights")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.list_carriers(airplanes_per_carrier(flights(spark, sf_dir)))
