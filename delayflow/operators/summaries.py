"""Aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayflow.operators.joins import join_dimension
from delayflow.operators.lookups import matching_flights
from delayflow.workspace import materialize

# Items held by one packed document; a larger group is spread over several.
DOCUMENT_ITEMS = 10_000


def route_avg_distance(df: DataFrame, descending: bool = False) -> DataFrame:
    """Average distance per pair of airports, ordered by it."""
    routes = df.groupBy("Origin", "Dest").agg(F.avg("Distance").alias("Distance"))
    distance = F.col("Distance").desc() if descending else F.col("Distance").asc()
    return routes.orderBy(distance, "Origin", "Dest")


def prediction_distribution(df: DataFrame, prediction: str = "Prediction") -> DataFrame:
    return df.groupBy(prediction).agg(F.count("*").alias("count"))


def null_counts(df: DataFrame) -> DataFrame:
    """Columns that hold NULLs and how many, from one pass over all of them."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns]
    )
    return counted.select(F.inline(pairs)).filter(F.col("nulls") > 0)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def flights_by_month(df: DataFrame) -> DataFrame:
    months = df.groupBy("Year", "Month").agg(F.count("*").alias("total_flights"))
    return months.orderBy("Year", "Month")


def pack_documents(
    stored: DataFrame, key: str, fields: Sequence[str], name: str, max_items: int = DOCUMENT_ITEMS
) -> DataFrame:
    """A stored table of distinct items gathered into one array document per key.

    A key with more than ``max_items`` items, the NULL key as well, is spread by hash over
    ``Part`` documents of about that size, so no task gathers an unbounded group. The key
    of a document is ``(key, Part)``. The plan is the same whether any key is that large;
    both sides of its join are plain scans, which lets adaptive execution split the
    partition of a hot key.
    """
    # A struct is never NULL, so the NULL key meets its own count.
    same = F.struct(key).alias("_same")
    counts = stored.groupBy(same).agg(F.count("*").alias("_items")).filter(F.col("_items") > max_items)
    large = counts.select("_same", F.ceil(F.col("_items") / max_items).alias("_parts"))
    part = F.pmod(F.xxhash64(*fields), F.coalesce("_parts", F.lit(1)))
    joined = join_dimension(stored.withColumn("_same", same), large, ["_same"], "left")
    spread = joined.withColumn("Part", part).drop("_same", "_parts")
    item = F.struct(*fields) if len(fields) > 1 else F.col(fields[0])
    return spread.groupBy(key, "Part").agg(F.sort_array(F.collect_list(item)).alias(name))


def manufacturer_totals(df: DataFrame, packed: bool = False) -> DataFrame:
    """Airplanes per manufacturer; ``packed`` gives them as ``data`` arrays."""
    totals = df.groupBy("Manufacturer").agg(F.count("*").alias("Total"))
    if not packed:
        return totals
    bars = materialize(totals.withColumn("chart", F.lit("manufacturers")), "totals")
    packed_bars = pack_documents(bars, "chart", ["Manufacturer", "Total"], "data")
    return packed_bars.select("Part", "data")


def airplanes_per_carrier(df: DataFrame, max_items: int = DOCUMENT_ITEMS) -> DataFrame:
    """Fleet size and tail numbers per carrier; airplanes without a carrier are one fleet.

    A carrier none of whose flights has a tail number has a fleet of 0 and an empty array.
    """
    fleet = materialize(df.select("Carrier", "TailNum").distinct(), "fleet")
    same = F.struct("Carrier").alias("_same")
    counts = fleet.groupBy(same).agg(F.count("TailNum").alias("FleetCount"))
    documents = pack_documents(fleet, "Carrier", ["TailNum"], "TailNumbers", max_items)
    # The documents are the large side: they stay where they are while the counts are few. Arrays
    # are gathered without NULLs, so only the NULL of a carrier that has no other is left empty.
    counted = join_dimension(documents.withColumn("_same", same), counts, ["_same"], "inner")
    return counted.filter((F.size("TailNumbers") > 0) | (F.col("FleetCount") == 0)).select(
        "Carrier", "FleetCount", "Part", "TailNumbers"
    )


def flights_per_airplane(df: DataFrame, max_items: int = DOCUMENT_ITEMS) -> DataFrame:
    """Flights of each airplane as an array of named fields.

    Equal flights are counted before the shuffle and held once, with ``Copies``.
    """
    fields = ["Carrier", "FlightDate", "FlightNum", "Origin", "Dest"]
    flights = df.groupBy("TailNum", *fields).agg(F.count("*").alias("Copies"))
    stored = materialize(flights, "flights")
    return pack_documents(stored, "TailNum", [*fields, "Copies"], "Flights", max_items)


def delay_histogram(df: DataFrame, column: str, width: float) -> DataFrame:
    """Flights per delay bin; ``label`` is the lower end of the bin."""
    bins = df.filter(F.col(column).isNotNull()).select(
        (F.floor(F.col(column) / width) * width).cast("double").alias("label")
    )
    return bins.groupBy("label").agg(F.count("*").alias("value")).orderBy("label")


def search_total(df: DataFrame, **terms: str | None) -> DataFrame:
    """Number of flights a search hits."""
    return matching_flights(df, **terms).agg(F.count("*").alias("total"))


def series_max(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("max_value"))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "Prediction") -> DataFrame:
    """Share of rows predicted right."""
    hit = (F.col(label) == F.col(prediction)).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"))


def confusion_matrix(
    df: DataFrame,
    label: str = "label",
    prediction: str = "Prediction",
    classes: Sequence[float] = (0.0, 1.0, 2.0, 3.0),
) -> DataFrame:
    """Rows per label, one count column per predicted class.

    Predictions of other classes are counted as ``predicted_other``, missing ones as
    ``predicted_unknown``, so the counts of a label add up to its rows.
    """
    found = F.col(prediction)
    columns = [F.count_if(found == value).alias(f"predicted_{int(value)}") for value in classes]
    columns.append(F.count_if(~found.isin(*classes)).alias("predicted_other"))
    columns.append(F.count_if(found.isNull()).alias("predicted_unknown"))
    return df.groupBy(label).agg(*columns).orderBy(label)
