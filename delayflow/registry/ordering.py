"""Queries for sorting, top-k and paging."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayflow.operators import ordering as O
from delayflow.operators.summaries import flights_by_month, route_avg_distance
from delayflow.registry import query
from delayflow.registry.lookups import PAGE, ordered
from delayflow.registry.tables import comparable, features, flights, stored_flights, view


@query("sort_features", "SELECT * FROM features")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(O.sort_features(features(spark, sf_dir)))


_ROUTES = "SELECT Origin, Dest, Distance FROM routes"


@query("longest_routes", f"{_ROUTES} ORDER BY Distance DESC, Origin, Dest LIMIT 20")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.longest_shortest_routes(route_avg_distance(flights(spark, sf_dir)), 20, longest=True)


@query("longest_shortest_routes", f"{_ROUTES} ORDER BY Distance, Origin, Dest LIMIT 20")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.longest_shortest_routes(route_avg_distance(flights(spark, sf_dir)), 20, longest=False)


@query(
    "sort_by_month",
    """SELECT Year, Month, count(*) AS total_flights FROM flights GROUP BY Year, Month
    ORDER BY Year, Month""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.sort_by_month(flights_by_month(flights(spark, sf_dir)))


@query("sort_by_dep_arr", "SELECT * FROM flights ORDER BY DepTime NULLS FIRST, ArrTime NULLS FIRST")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.sort_by_dep_arr(flights(spark, sf_dir))


@query(
    "sample_topk",
    """SELECT CRSDepTime, count(*) AS flights FROM (SELECT CRSDepTime FROM features
    ORDER BY CRSDepTime NULLS FIRST LIMIT 6) GROUP BY CRSDepTime
    UNION ALL SELECT NULL AS CRSDepTime, CAST(0 AS BIGINT) AS flights FROM region WHERE r_regionkey = 0""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The earliest of a sample of all rows, which SQL can follow; and none of a smaller sample may be
    # foreign to the table, which adds a row of 0.
    whole = features(spark, sf_dir)
    found = comparable(O.sample_topk(whole, fraction=1.0)).groupBy("CRSDepTime").agg(F.count("*").alias("flights"))
    foreign = O.sample_topk(whole).exceptAll(whole).agg(F.count("*").alias("flights"))
    return found.unionByName(foreign.select(F.lit(None).cast("timestamp_ntz").alias("CRSDepTime"), "flights"))


@query("page_flights", f"SELECT * FROM flights ORDER BY {PAGE} LIMIT 15 OFFSET 45")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.page_flights(flights(spark, sf_dir), start=45)


@query("page_flights_deep", f"SELECT * FROM flights ORDER BY {PAGE} LIMIT 15 OFFSET 30000")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.page_flights(flights(spark, sf_dir), start=30000)


@query("page_after", f"SELECT * FROM flights ORDER BY {PAGE} LIMIT 15 OFFSET 45")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Three pages of 15 and the one behind them, each from where the last one ended.
    whole, cursor = stored_flights(spark, sf_dir), None
    for _ in range(4):
        page, cursor = O.page_after(whole, O.PAGE_ORDER, cursor)
    return page


@query(
    "page_after_deep",
    f"""SELECT * FROM flights WHERE FlightDate >
      (SELECT min(FlightDate) + CAST((max(FlightDate) - min(FlightDate)) // 2 AS INTEGER) FROM flights)
    ORDER BY {PAGE} LIMIT 15""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = stored_flights(spark, sf_dir)
    first, last_day = F.min("FlightDate"), F.max("FlightDate")
    middle = whole.agg(F.date_add(first, F.floor(F.datediff(last_day, first) / 2).cast("int"))).first()[0]
    middle = whole.filter(F.col("FlightDate") <= F.lit(middle)).agg(F.max("FlightDate")).first()[0]
    # The cursor of a page that ended with the last row of the first half.
    names = O.PAGE_ORDER + [c for c in whole.columns if c not in O.PAGE_ORDER]
    day = whole.filter(F.col("FlightDate") == F.lit(middle))
    last = day.orderBy(*[F.col(c).desc_nulls_first() for c in names]).first()
    same = day.filter(reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.lit(last[c])) for c in names]))
    page, _ = O.page_after(whole, O.PAGE_ORDER, O.Cursor(tuple(last[c] for c in names), same.count()))
    return page


@query(
    "nav_offsets",
    """SELECT *, next_bottom >= 0 AND next_top > 0 AND total > next_bottom AS next_shown,
      previous_bottom >= 0 AND previous_top > 0 AND total > previous_bottom AS previous_shown
    FROM (SELECT *, "start" + 15 AS next_bottom, "end" + 15 AS next_top,
      greatest("start" - 15, 0) AS previous_bottom, greatest("end" - 15, 0) AS previous_top
      FROM (SELECT UUID, CAST(FlightNum AS INT) AS "start", CAST(FlightNum AS INT) + 15 AS "end",
        CAST(UUID AS INT) AS total FROM requests))""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = view(spark, sf_dir, "requests").select(
        "UUID",
        F.col("FlightNum").cast("int").alias("start"),
        (F.col("FlightNum").cast("int") + 15).alias("end"),
        F.col("UUID").cast("int").alias("total"),
    )
    return O.nav_offsets(pages)


@query("preview", f"SELECT * FROM flights ORDER BY {ordered(nulls='FIRST')} LIMIT 6")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.preview(flights(spark, sf_dir), 6)
