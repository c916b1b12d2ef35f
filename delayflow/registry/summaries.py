"""Queries for aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayflow.operators import rollups as R
from delayflow.operators import summaries as S
from delayflow.registry import query
from delayflow.registry.tables import flights, stored, stored_path, view


@query("route_avg_distance", "SELECT Origin, Dest, Distance FROM routes ORDER BY Distance")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.route_avg_distance(flights(spark, sf_dir))


@query(
    "prediction_distribution",
    'SELECT Prediction, count(*) AS "count" FROM scored GROUP BY Prediction',
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.prediction_distribution(view(spark, sf_dir, "scored"))


_NULLABLE = ["DepDelay", "ArrDelay", "DepTime", "ArrTime"]


@query(
    "null_counts",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS nulls FROM flights WHERE {c} IS NULL
        HAVING count(*) > 0"""
        for c in [*_NULLABLE, "FlightNum", "FlightDate", "Carrier", "TailNum", "Origin", "Dest",
                  "Distance", "CRSDepTime", "CRSArrTime", "AirTime"]
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.null_counts(flights(spark, sf_dir))


@query("row_count", 'SELECT count(*) AS "rows" FROM flights')
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.row_count(flights(spark, sf_dir))


@query("distinct_rows", "SELECT DISTINCT * FROM flights")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.distinct_rows(flights(spark, sf_dir))


@query(
    "flights_by_month",
    "SELECT Year, Month, count(*) AS total_flights FROM flights GROUP BY Year, Month",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.flights_by_month(flights(spark, sf_dir))


_TOTALS = "SELECT Manufacturer, count(*) AS Total FROM airplanes GROUP BY Manufacturer"


@query("manufacturer_totals", _TOTALS)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.manufacturer_totals(view(spark, sf_dir, "airplanes"))


@query("manufacturer_totals_packed", _TOTALS)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = S.manufacturer_totals(view(spark, sf_dir, "airplanes"), packed=True)
    return packed.select(F.inline("data"))


@query(
    "airplanes_per_carrier",
    """SELECT * FROM (SELECT Carrier, count(TailNum) OVER (PARTITION BY Carrier) AS FleetCount, TailNum
    FROM (SELECT DISTINCT Carrier, TailNum FROM flights)) WHERE TailNum IS NOT NULL OR FleetCount = 0""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.airplanes_per_carrier(flights(spark, sf_dir)).select(
        "Carrier", "FleetCount", F.explode_outer("TailNumbers").alias("TailNum")
    )


@query(
    "flights_per_airplane",
    """SELECT TailNum, Carrier, FlightDate, FlightNum, Origin, Dest, count(*) AS Copies
    FROM flights GROUP BY ALL""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.flights_per_airplane(flights(spark, sf_dir)).select("TailNum", F.inline("Flights"))


def _loaded(spark: SparkSession, sf_dir: str) -> str:
    """Partial counts of the flights in three loads, the second of which came twice."""

    needed = sorted({c for keys in R.PARTIALS.values() for c in keys})

    def load(path: str) -> None:
        # Stored, as every load reads it: the joins behind it are made once.
        whole = stored(spark, sf_dir, "loads", lambda: flights(spark, sf_dir).select(*needed))
        part = F.pmod(F.crc32(F.col("FlightNum").cast("binary")), F.lit(3))
        for number in (0, 1, 2, 1):
            R.merge_day(whole.filter(part == number), path, f"2024-01-0{number + 1}")

    return stored_path(spark, sf_dir, "partials", load)


@query(
    "flights_by_month_so_far",
    "SELECT Year, Month, count(*) AS total_flights FROM flights GROUP BY Year, Month",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.months_so_far(spark, _loaded(spark, sf_dir))


@query(
    "airplanes_per_carrier_so_far",
    """SELECT * FROM (SELECT Carrier, count(TailNum) OVER (PARTITION BY Carrier) AS FleetCount, TailNum
    FROM (SELECT DISTINCT Carrier, TailNum FROM flights)) WHERE TailNum IS NOT NULL OR FleetCount = 0""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.fleets_so_far(spark, _loaded(spark, sf_dir)).select(
        "Carrier", "FleetCount", F.explode_outer("TailNumbers").alias("TailNum")
    )


@query(
    "flights_per_airplane_so_far",
    """SELECT TailNum, Carrier, FlightDate, FlightNum, Origin, Dest, count(*) AS Copies
    FROM flights GROUP BY ALL""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.airplanes_so_far(spark, _loaded(spark, sf_dir)).select("TailNum", F.inline("Flights"))


@query(
    "delay_histogram",
    """SELECT CAST(floor(ArrDelay / 15) * 15 AS DOUBLE) AS label, count(*) AS "value"
    FROM flights WHERE ArrDelay IS NOT NULL GROUP BY 1""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.delay_histogram(flights(spark, sf_dir), "ArrDelay", 15)


@query(
    "search_total",
    "SELECT count(*) AS total FROM flights WHERE Carrier = 'C01' AND Origin = 'A19'",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.search_total(flights(spark, sf_dir), Carrier="C01", Origin="A19")


@query(
    "series_max",
    """SELECT max(total_flights) AS max_value FROM
    (SELECT count(*) AS total_flights FROM flights GROUP BY Year, Month)""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.series_max(S.flights_by_month(flights(spark, sf_dir)), "total_flights")


@query(
    "accuracy",
    """SELECT avg(CASE WHEN label = Prediction THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS accuracy
    FROM scored""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.accuracy(view(spark, sf_dir, "scored"))


@query(
    "confusion_matrix",
    """SELECT label, count(*) FILTER (Prediction = 0) AS predicted_0,
    count(*) FILTER (Prediction = 1) AS predicted_1, count(*) FILTER (Prediction = 2) AS predicted_2,
    count(*) FILTER (Prediction = 3) AS predicted_3,
    count(*) FILTER (Prediction NOT IN (0, 1, 2, 3)) AS predicted_other,
    count(*) FILTER (Prediction IS NULL) AS predicted_unknown FROM scored GROUP BY label""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.confusion_matrix(view(spark, sf_dir, "scored"))
