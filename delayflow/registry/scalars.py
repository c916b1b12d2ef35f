"""Queries for the column expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from delayflow.functions import labels, text, times, values
from delayflow.registry import query
from delayflow.registry.tables import comparable, flights, table, view
from delayflow.schemas import AIRPLANES_PER_PAGE


@query("hhmm_to_time", "SELECT FlightNum, CRSDepTime, dep_clock, CRSArrTime, arr_clock FROM clocks")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights(spark, sf_dir).select(
        "FlightNum",
        "CRSDepTime",
        times.hhmm_to_time(F.col("CRSDepTime")).alias("dep_clock"),
        "CRSArrTime",
        times.hhmm_to_time(F.col("CRSArrTime")).alias("arr_clock"),
    )


@query("compose_timestamp", "SELECT FlightNum, FlightDate, CRSDepTime, dep FROM instants")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    dep = times.compose_timestamp(F.col("FlightDate"), F.col("CRSDepTime"))
    return comparable(
        flights(spark, sf_dir).select("FlightNum", "FlightDate", "CRSDepTime", dep.alias("dep"))
    )


@query(
    "overnight_rollover",
    """SELECT FlightNum, dep, CASE WHEN arr < dep THEN arr + INTERVAL 1 DAY ELSE arr END AS arr
    FROM instants""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    dep = times.compose_timestamp(F.col("FlightDate"), F.col("CRSDepTime"))
    arr = times.compose_timestamp(F.col("FlightDate"), F.col("CRSArrTime"))
    return comparable(
        flights(spark, sf_dir).select(
            "FlightNum", dep.alias("dep"), times.overnight_rollover(dep, arr).alias("arr")
        )
    )


@query(
    "day_of_year",
    "SELECT FlightNum, FlightDate, CAST(dayofyear(FlightDate) AS INT) AS DayOfYear FROM flights",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights(spark, sf_dir).select(
        "FlightNum", "FlightDate", times.day_of_year(F.col("FlightDate")).alias("DayOfYear")
    )


@query(
    "month_day_string",
    "SELECT FlightNum, CAST(Month AS VARCHAR) || '-' || DayofMonth AS month_day FROM flights",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    month_day = times.month_day_string(F.col("Month"), F.col("DayofMonth"))
    return flights(spark, sf_dir).select("FlightNum", month_day.alias("month_day"))


@query(
    "request_date_parts",
    """SELECT UUID, FlightDate, CAST(dayofyear(FlightDate) AS INT) AS DayOfYear,
    CAST(day(FlightDate) AS INT) AS DayOfMonth, CAST(isodow(FlightDate) - 1 AS INT) AS DayOfWeek
    FROM requests""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = view(spark, sf_dir, "requests").select("UUID", "FlightDate")
    return times.request_date_parts(requests)


@query(
    "iso_day_bounds",
    """SELECT UUID, strftime(FlightDate, '%Y-%m-%d') AS iso_today,
    strftime(FlightDate + INTERVAL 1 DAY, '%Y-%m-%d') AS iso_tomorrow FROM requests""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = times.iso_day_bounds(F.col("Timestamp"))
    return view(spark, sf_dir, "requests").select("UUID", bounds.alias("b")).select("UUID", "b.*")


@query(
    "int_casts",
    """SELECT UUID, CAST(trunc(DepDelay) AS INT) AS DepDelay, CAST(FlightNum AS INT) AS FlightNum
    FROM requests""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = view(spark, sf_dir, "requests").select("UUID", "DepDelay", "FlightNum")
    return values.int_casts(requests, ["DepDelay", "FlightNum"])


@query("value_to_string", "SELECT event_id, props AS value FROM events")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = F.encode("props", "utf-8")
    return table(spark, sf_dir, "events").select(
        "event_id", text.value_to_string(message).alias("value")
    )


@query(
    "parse_json",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k,
    TRUE AS malformed_is_null FROM events""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = StructType().add("k", "integer")
    parsed = text.parse_json(F.col("props"), schema)
    malformed = text.parse_json(F.concat(F.lit("]"), "props"), schema)
    return table(spark, sf_dir, "events").select(
        "event_id", parsed["k"].alias("k"), malformed["k"].isNull().alias("malformed_is_null")
    )


@query(
    "to_json_record",
    """SELECT '{"UUID":"' || UUID || '","Timestamp":"' || "Timestamp" || '"'
    || CASE WHEN event_type = 'error' THEN '' ELSE ',"event_type":"' || event_type || '"' END
    || ',"Origin":"' || Origin || '","Dest":"' || Dest || '"}' AS value FROM requests""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = view(spark, sf_dir, "requests").select(
        "UUID", "Timestamp", F.nullif("event_type", F.lit("error")).alias("event_type"), "Origin", "Dest"
    )
    return text.to_json_record(requests)


def _decode_sql(cases: str, otherwise: str) -> str:
    return f"""SELECT FlightNum, Prediction,
    CASE {cases.replace('@', 'Prediction')} ELSE {otherwise.replace('@', 'Prediction')} END AS shown,
    CASE {cases.replace('@', '(Prediction + 2)')}
      ELSE {otherwise.replace('@', '(Prediction + 2)')} END AS shifted FROM scored"""


def _decoded(spark: SparkSession, sf_dir: str, decode) -> DataFrame:
    # Shifted classes reach 5, to show what becomes of unknown ones.
    return view(spark, sf_dir, "scored").select(
        "FlightNum",
        "Prediction",
        decode(F.col("Prediction")).alias("shown"),
        decode((F.col("Prediction") + 2).cast("string")).alias("shifted"),
    )


@query(
    "decode_label_minutes",
    _decode_sql(
        """WHEN @ = 0 THEN 'Early (15+ Minutes Early)'
        WHEN @ = 1 THEN 'Slightly Early (0-15 Minute Early)'
        WHEN @ = 2 THEN 'Slightly Late (0-30 Minute Delay)'
        WHEN @ = 3 THEN 'Very Late (30+ Minutes Late)'""",
        "NULL",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded(spark, sf_dir, labels.decode_label_minutes)


@query(
    "decode_label_batch",
    _decode_sql(
        """WHEN @ = 0 THEN 'On Time (0-15 Minute Delay)'
        WHEN @ = 1 THEN 'Slightly Late (15-60 Minute Delay)'
        WHEN @ = 2 THEN 'Very Late (60+ Minute Delay)'""",
        "''",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded(spark, sf_dir, labels.decode_label_batch)


@query(
    "decode_label_short",
    _decode_sql(
        """WHEN @ = 0 THEN 'On time' WHEN @ = 1 THEN 'Slight delay'
        WHEN @ = 2 THEN 'Very late' WHEN @ = 3 THEN 'Extremely late'""",
        "CAST(@ AS VARCHAR)",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded(spark, sf_dir, labels.decode_label_short)


@query(
    "truncate_label",
    """SELECT TailNum, Owner, CASE WHEN length(Owner) > 14 THEN substr(Owner, 1, 14) || '...'
    ELSE Owner END AS axis_label FROM airplanes""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "airplanes").select(
        "TailNum", "Owner", text.truncate_label(F.col("Owner")).alias("axis_label")
    )


@query(
    "strip_paging_from_url",
    """SELECT page_id, url AS paged, url || '?Carrier=AA&start=0&end=15' AS filtered, url AS plain
    FROM pages""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    filtered = F.concat(url, F.lit("?Carrier=AA&start=0&end=15"))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        text.strip_paging_from_url(F.concat(url, F.lit("?start=0&end=15"))).alias("paged"),
        text.strip_paging_from_url(filtered).alias("filtered"),
        text.strip_paging_from_url(url).alias("plain"),
    )


@query("default_if_missing", "SELECT FlightNum, coalesce(DepDelay, 0) AS DepDelay FROM flights")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    delay = values.default_if_missing(F.col("DepDelay"), 0)
    return flights(spark, sf_dir).select("FlightNum", delay.alias("DepDelay"))


@query("request_id", "SELECT count(*) AS requests, count(*) AS ids FROM requests")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = view(spark, sf_dir, "requests").select(values.request_id().alias("id"))
    return numbered.agg(F.count("*").alias("requests"), F.count_distinct("id").alias("ids"))


@query(
    "request_timestamp",
    "SELECT count(*) AS requests, count(*) AS readable, CAST(1 AS BIGINT) AS stamps FROM requests",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = view(spark, sf_dir, "requests").select(times.request_timestamp().alias("stamp"))
    readable = F.try_to_timestamp("stamp", F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).isNotNull()
    return stamped.agg(
        F.count("*").alias("requests"),
        F.count_if(readable).alias("readable"),
        F.count_distinct("stamp").alias("stamps"),
    )


@query(
    "request_defaults",
    """SELECT UUID, CASE WHEN event_type = 'click' THEN 0 ELSE CAST(FlightNum AS INT) END AS start,
    CASE WHEN event_type = 'view' THEN 5 ELSE CAST(FlightNum AS INT) + 5 END AS "end" FROM requests""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("FlightNum").cast("int")
    raw = view(spark, sf_dir, "requests").select(
        "UUID",
        F.when(F.col("event_type") != "click", number.cast("string")).alias("start"),
        F.when(F.col("event_type") != "view", (number + 5).cast("string")).alias("end"),
    )
    return values.request_defaults(raw, AIRPLANES_PER_PAGE)
