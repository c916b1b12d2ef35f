"""Queries for projections, filters and feature extraction."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayflow.operators import projection as P
from delayflow.registry import query
from delayflow.registry.tables import comparable, enriched, features, flights, stored, view
from delayflow.schemas import STREAM_REQUEST_FIELDS
from delayflow.workspace import materialize, width_for


@query(
    "project_features",
    """SELECT FlightNum, FlightDate, DayOfWeek, DayofMonth AS DayOfMonth,
    CAST(Month AS VARCHAR) || '-' || DayofMonth AS DayOfYear, Carrier, Origin, Dest, Distance,
    DepDelay, ArrDelay, CRSDepTime, CRSArrTime FROM flights""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.project_features(flights(spark, sf_dir))


@query(
    "filter_not_null_delays",
    "SELECT * FROM flights WHERE ArrDelay IS NOT NULL AND DepDelay IS NOT NULL",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.filter_not_null_delays(flights(spark, sf_dir))


# Rows that one task compares with a sample.
TASK_ROWS = 500_000


def copies_of(whole: DataFrame, samples: Mapping[str, DataFrame], width: int) -> DataFrame:
    """Distinct rows of a table and its samples, and how often each is in any of them.

    The difference of the numbers is what ``exceptAll`` would leave. Rows are dealt by all columns
    before they are grouped, so a task holds its share of them and no more.
    """
    names = list(samples)

    def marked(df: DataFrame, name: str) -> DataFrame:
        return df.select(*whole.columns, *[F.lit(int(n == name)).alias(n) for n in ("_whole", *names)])

    both = reduce(DataFrame.unionByName, [marked(whole, "_whole"), *[marked(df, n) for n, df in samples.items()]])
    dealt = both.repartition(width, *whole.columns)
    return dealt.groupBy(*whole.columns).agg(*[F.sum(n).alias(n) for n in ("_whole", *names)])


@query(
    "sample_bernoulli",
    """SELECT how, FlightDate, count(*) AS flights, CAST(0 AS BIGINT) AS foreign_rows, TRUE AS near_fraction
    FROM (SELECT *, unnest(['drawn', 'by_key']) AS how FROM flights) GROUP BY how, FlightDate""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    # SQL cannot draw the same rows: it is shown that a sample and the rest are the whole, and
    # that the sample's size is within five deviations of what is asked for.
    whole = stored(spark, sf_dir, "projected", lambda: P.project_features(flights(spark, sf_dir)))
    rows, fraction = whole.count(), 0.1
    most = 5 * (rows * fraction * (1 - fraction)) ** 0.5
    keys = {"drawn": None, "by_key": whole.columns}
    samples = {
        how: stored(spark, sf_dir, f"sample-{how}", lambda: P.sample_bernoulli(whole, fraction, key=key))
        for how, key in keys.items()
    }
    near = {how: abs(sample.count() - rows * fraction) <= most for how, sample in samples.items()}
    copies = copies_of(whole, samples, width_for(spark, rows, TASK_ROWS))
    # A row is drawn or left; what is drawn more often than it is there is foreign.
    counted = copies.groupBy("FlightDate").agg(
        *[F.sum(F.greatest(how, "_whole")).alias(how) for how in samples],
        *[F.sum(F.greatest(F.col(how) - F.col("_whole"), F.lit(0))).alias(f"{how}_foreign") for how in samples],
    )
    days = materialize(counted, "days")
    foreign = days.agg(*[F.coalesce(F.sum(f"{how}_foreign"), F.lit(0)).alias(how) for how in samples]).first()
    parts = [
        days.select(
            F.lit(how).alias("how"), "FlightDate", F.col(how).alias("flights"),
            F.lit(foreign[how]).cast("long").alias("foreign_rows"), F.lit(near[how]).alias("near_fraction"),
        )
        for how in samples
    ]
    return parts[0].unionByName(parts[1])


@query("extract_features", "SELECT * FROM features")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(features(spark, sf_dir))


@query(
    "derive_route",
    """SELECT FlightNum, Origin, Dest, Origin || '-' || Dest AS Route FROM (
    SELECT FlightNum, nullif(Origin, 'A07') AS Origin, Dest FROM flights)""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One airport is blanked, so that routes without an origin occur.
    ends = flights(spark, sf_dir).select(
        "FlightNum", F.nullif("Origin", F.lit("A07")).alias("Origin"), "Dest"
    )
    return P.derive_route(ends)


@query("drop_rename_columns", "SELECT FlightNum, Carrier, label, Prediction FROM scored")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = view(spark, sf_dir, "scored").select(
        "FlightNum",
        "Carrier",
        "label",
        F.col("Prediction").alias("prediction"),
        F.col("label").alias("Carrier_index"),
        F.array("label").alias("Features_vec"),
        F.array("label").alias("probability"),
    )
    return P.drop_rename_columns(scored)


@query(
    "flatten_struct",
    """SELECT Origin, FlightNum, DayOfWeek, DayOfYear, DayOfMonth, Dest, DepDelay, "Timestamp",
    FlightDate, Carrier, UUID, Distance FROM enriched""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = enriched(spark, sf_dir).select(F.struct("*").alias("flight"))
    return P.flatten_struct(nested, "flight", STREAM_REQUEST_FIELDS)


@query(
    "coerce_request_fields",
    """SELECT UUID, CASE WHEN event_type = 'signup' THEN NULL ELSE DepDelay END AS DepDelay,
    Carrier, CAST(FlightDate AS VARCHAR) AS FlightDate, Dest, FlightNum,
    CAST(NULL AS VARCHAR) AS Origin FROM requests""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Form text: some delays cannot be read as numbers, and no origin is sent.
    form = view(spark, sf_dir, "requests").select(
        "UUID",
        F.when(F.col("event_type") == "signup", F.concat(F.col("DepDelay"), F.lit(" min")))
        .otherwise(F.col("DepDelay").cast("string"))
        .alias("DepDelay"),
        "Carrier",
        F.col("FlightDate").cast("string").alias("FlightDate"),
        "Dest",
        "FlightNum",
    )
    return P.coerce_request_fields(form)
