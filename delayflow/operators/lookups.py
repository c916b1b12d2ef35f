"""Point lookups, searches and lists over tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from delayflow.functions.text import search_tokens
from delayflow.operators.ordering import PAGE_ORDER, full_order, nav_offsets, page_by, page_flights, page_names
from delayflow.schemas import AIRPLANES_PER_PAGE, DAY_COLUMN, FLIGHTS_PER_PAGE
from delayflow.workspace import materialize

# Fields that can be searched.
FLIGHT_TERMS = ["Carrier", "FlightDate", "Origin", "Dest", "TailNum", "FlightNum"]
AIRPLANE_TERMS = [
    "TailNum", "Owner", "OwnerState", "Manufacturer", "Model", "ManufacturerYear",
    "SerialNumber", "EngineManufacturer", "EngineModel",
]


def _equals(df: DataFrame, name: str, value: str) -> Column:
    # The literal takes the column's type, so that the comparison reaches the scan. Text
    # that is no such value equals nothing.
    return F.col(name) == F.lit(value).try_cast(df.schema[name].dataType)


def _all_of(predicates: list[Column]) -> Column:
    return reduce(lambda left, right: left & right, predicates, F.lit(True))


def lookup_flight(
    df: DataFrame, carrier: str | None, flight_date: str | None, flight_num: str | None
) -> DataFrame:
    """The first flight with these values; a missing argument matches NULL."""
    wanted = {"Carrier": carrier, "FlightDate": flight_date, "FlightNum": flight_num}
    terms = [F.col(c).isNull() if v is None else _equals(df, c, v) for c, v in wanted.items()]
    found = df.filter(_all_of(terms))
    return found.orderBy(*full_order(df, [])).limit(1)


def list_route_flights(df: DataFrame, origin: str, dest: str, flight_date: str) -> DataFrame:
    """Flights between two airports on a day, by departure and arrival."""
    wanted = {"Origin": origin, "Dest": dest, "FlightDate": flight_date}
    found = df.filter(_all_of([_equals(df, c, v) for c, v in wanted.items()]))
    # A handful of rows: they are ordered as they are found.
    return found.orderBy(*full_order(found, ["DepTime", "ArrTime"]))


def _given(terms: Mapping[str, str | None], allowed: list[str]) -> dict[str, str]:
    unknown = set(terms) - set(allowed)
    if unknown:
        raise ValueError(f"not searchable: {sorted(unknown)}")
    return {name: value for name, value in terms.items() if value}


def matching_flights(df: DataFrame, **terms: str | None) -> DataFrame:
    """Flights equal to every given term; absent or empty terms do not restrict."""
    given = _given(terms, FLIGHT_TERMS)
    return df.filter(_all_of([_equals(df, c, v) for c, v in given.items()]))


def search_flights(
    df: DataFrame, start: int = 0, size: int = FLIGHTS_PER_PAGE, **terms: str | None
) -> DataFrame:
    """One page of the flights a search hits."""
    return page_flights(matching_flights(df, **terms), start, size)


def search_page(
    df: DataFrame, start: int = 0, size: int = FLIGHTS_PER_PAGE, **terms: str | None
) -> DataFrame:
    """One row for a page: the rows of a search (array ``flights``, in page order), the ``total`` of its hits,
    ``start``, ``end`` and the paging links.

    A search without hits, or a page beyond the last, has an empty array.
    """
    counted = Observation()
    found = matching_flights(df, **terms).observe(counted, F.count(F.lit(1)).alias("total"))
    # The job that stores the page counts all hits on its way: they are read once.
    rows = materialize(page_by(found, page_names(df, PAGE_ORDER), start, size), "page")
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    # No more rows than a page has are gathered.
    gathered = rows.orderBy(*full_order(df, PAGE_ORDER, nulls_last=True)).agg(F.collect_list(row).alias("flights"))
    placed = gathered.withColumns(
        {"start": F.lit(start), "end": F.lit(start + size), "total": F.lit(counted.get["total"])}
    )
    return nav_offsets(placed, increment=size)


def search_airplanes(
    df: DataFrame, start: int = 0, size: int = AIRPLANES_PER_PAGE, **terms: str | None
) -> DataFrame:
    """One page of airplanes sharing a word with every given term.

    ``score`` is the number of query words found. Pages run by owner, then by
    falling score.
    """
    given = _given(terms, AIRPLANE_TERMS)
    hits = [
        F.size(F.array_intersect(search_tokens(F.col(c)), search_tokens(F.lit(v))))
        for c, v in given.items()
    ]
    found = df.filter(_all_of([h > 0 for h in hits]))
    scored = found.withColumn("score", reduce(lambda a, b: a + b, hits, F.lit(0)))
    ranked = scored.withColumn("_rank", -F.col("score"))
    return page_by(ranked, page_names(ranked, ["Owner", "_rank"]), start, size).drop("_rank")


def requests_in_day(
    df: DataFrame, iso_day: str, column: str = "Timestamp", half_open: bool = False
) -> DataFrame:
    """Requests of a day by comparing ISO text with the day and the day after.

    Both ends belong to the range: bare text of the next day matches too, text with
    a time on it does not. ``half_open`` leaves the end out. A table kept by day is read
    only for the day and its neighbours.
    """
    day = F.lit(iso_day).cast("date")
    if DAY_COLUMN in df.columns:
        near = F.col(DAY_COLUMN).between(F.date_sub(day, 1), F.date_add(day, 1))
        # Times that are no date are kept apart; their text is compared all the same.
        df = df.filter(near | F.col(DAY_COLUMN).isNull())
    moment, first = F.col(column), F.lit(iso_day)
    last = F.date_format(F.date_add(day, 1), "yyyy-MM-dd")
    return df.filter((moment >= first) & ((moment < last) if half_open else (moment <= last)))


def lookup_distance(dim: DataFrame, origin: str, dest: str) -> DataFrame:
    """Distance of one pair of airports; no row if unknown."""
    return dim.filter((F.col("Origin") == origin) & (F.col("Dest") == dest)).select("Distance")


def lookup_prediction_status(responses: DataFrame, uuid: str, moment: str = "Timestamp") -> DataFrame:
    """Status of one request: OK with the prediction of its first answer, or WAIT; always one row.

    Answers of one time, or of a table without that column, are ordered by their prediction.
    """
    order = [F.col(moment).isNull(), F.col(moment)] if moment in responses.columns else []
    first = F.min(F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)], "Prediction")).alias("first")
    found = responses.filter(F.col("UUID") == uuid).agg(F.count("*").alias("answers"), first)
    status = F.when(F.col("answers") > 0, "OK").otherwise("WAIT")
    return found.select(F.lit(uuid).alias("id"), status.alias("status"), F.col("first.Prediction").alias("Prediction"))


def list_carriers(fleet: DataFrame) -> DataFrame:
    """Carriers of the fleet view; a fleet in several parts counts once."""
    return fleet.select("Carrier").distinct().orderBy("Carrier")
