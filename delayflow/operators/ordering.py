"""Sorting, top-k and paging."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delayflow.operators.projection import sample_bernoulli
from delayflow.schemas import FLIGHTS_PER_PAGE
from delayflow.workspace import discard, materialize, new_path

# Sort keys.
FEATURE_ORDER = [
    "DayOfYear", "Carrier", "Origin", "Dest", "FlightNum", "CRSDepTime", "CRSArrTime",
]
PAGE_ORDER = ["FlightDate", "DepTime", "Carrier", "FlightNum"]

# Rows up to which a page is cut from a top-k, which merges that many rows of every task
# in one; pages further on are found by position.
TOP_K_ROWS = 1_000

# Values of a sort column whose counts come to the driver to find a page.
MAX_VALUES = 100_000

# Bits of a row id of Spark that number the rows inside a partition.
PLACE_BITS = 33


def full_order(df: DataFrame, keys: Sequence[str], nulls_last: bool = False) -> list[Column]:
    """The keys that exist, then every other column as a tie-break.

    The tie-break makes the order total, and lets a range shuffle cut between rows
    that share a popular key.
    """
    names = [k for k in keys if k in df.columns]
    names += [c for c in df.columns if c not in names]
    if nulls_last:
        return [F.col(c).asc_nulls_last() for c in names]
    return [F.col(c).asc_nulls_first() for c in names]


def sort_stored(stored: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """A stored table in a global order, whatever its size and number of equal rows.

    Equal rows would all fall into one range of the sort's shuffle. The number a row has
    in the stored table tells copies apart and lets a range end between them.
    """
    numbered = stored.withColumn("_copy", F.monotonically_increasing_id())
    return numbered.orderBy(*order, "_copy").drop("_copy")


def sort_rows(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Rows in a global order.

    A sort samples its input for the ranges before it shuffles it; storing the input
    saves computing it twice.
    """
    return sort_stored(materialize(df, "unsorted"), order)


def sort_features(df: DataFrame) -> DataFrame:
    return sort_rows(df, full_order(df, FEATURE_ORDER))


def sort_by_month(df: DataFrame) -> DataFrame:
    """Monthly totals in order; there are few of them."""
    return df.orderBy(*full_order(df, ["Year", "Month"]))


def sort_by_dep_arr(df: DataFrame) -> DataFrame:
    return sort_rows(df, full_order(df, ["DepTime", "ArrTime"]))


def longest_shortest_routes(routes: DataFrame, n: int, longest: bool = True) -> DataFrame:
    """The ``n`` routes of greatest or least distance."""
    distance = F.col("Distance").desc() if longest else F.col("Distance").asc()
    return routes.orderBy(distance, "Origin", "Dest").limit(n)


def sample_topk(df: DataFrame, fraction: float = 0.001, seed: int = 18, n: int = 6) -> DataFrame:
    """The ``n`` earliest departures of a sample."""
    return preview(sample_bernoulli(df, fraction, seed), n, ["CRSDepTime"])


def preview(df: DataFrame, n: int, order: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows of a total order."""
    return df.orderBy(*full_order(df, order)).limit(n)


def ordered_table(df: DataFrame, order: Sequence[Column], name: str = "ordered") -> DataFrame:
    """A stored copy in a global order, with ``_id``: the sort partition and the place in it.

    A window over the whole frame would sort it in one task. Here the sort is range
    partitioned. Rows are written in the order of ``_id``, so ranges of it reach the scan.
    """
    place = new_path(df.sparkSession, "unsorted")
    ordered = sort_stored(materialize(df, "unsorted", place), order)
    stored = materialize(ordered.withColumn("_id", F.monotonically_increasing_id()), name)
    discard(df.sparkSession, place)
    return stored


def partition_counts(stored: DataFrame) -> DataFrame:
    """Rows per sort partition of an ordered table; as many as the sort's shuffle is wide."""
    partition = F.shiftright("_id", PLACE_BITS).cast("int").alias("_partition")
    return stored.groupBy(partition).agg(F.count("*").alias("_rows"))


def number_rows(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add each row's position in a global order, from 0.

    Only one count per sort partition is summed up to turn places into positions.
    """
    stored = ordered_table(df, order)
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    starts = partition_counts(stored).select(
        "_partition", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    # One row per sort partition, so the copy is bounded by the shuffle width.
    return (
        stored.withColumn("_partition", F.shiftright("_id", PLACE_BITS).cast("int"))
        .join(F.broadcast(starts), "_partition")
        .withColumn(name, F.col("_start") + F.col("_id").bitwiseAND((1 << PLACE_BITS) - 1))
        .drop("_id", "_partition", "_start")
    )


def page_of_ordered(stored: DataFrame, start: int, size: int) -> DataFrame:
    """Rows ``start`` to ``start + size`` of an ordered table, which any number of pages share.

    The counts of the sort partitions, one row each, tell on the driver which ranges of
    ``_id`` the page is made of; the scan then skips all other row groups.
    """
    counts = sorted((r["_partition"], r["_rows"]) for r in partition_counts(stored).collect())
    wanted, passed = F.lit(False), 0
    for partition, rows in counts:
        low, high = max(start - passed, 0), min(start + size - passed, rows)
        if low < high:
            first = partition << PLACE_BITS
            wanted = wanted | F.col("_id").between(first + low, first + high - 1)
        passed += rows
    return stored.filter(wanted).orderBy("_id").drop("_id")


def page_by_counts(df: DataFrame, names: Sequence[str], start: int, size: int) -> DataFrame:
    """Rows ``start`` to ``start + size`` by the columns in order, missing values last; nothing is stored.

    Rows per value of the first column tell in which value the page begins. Within it the next
    column is counted, and so on, until the page is near enough to be a top-k of what is left. A page
    that goes over the end of a value is the end of that value and the beginning of what is behind it.
    Rows that are equal in all columns need no order. A column of more than ``MAX_VALUES``
    values is not counted on the driver; the rest is then sorted and stored instead.
    """
    rest, offset = df, start
    for place, name in enumerate(names):
        order = [F.col(c).asc_nulls_last() for c in names[place:]]
        if offset + size <= TOP_K_ROWS:
            return rest.orderBy(*order).offset(offset).limit(size)
        key = F.col(name)
        counted = rest.groupBy(name).agg(F.count("*").alias("_rows")).orderBy(key.asc_nulls_last())
        counts = counted.limit(MAX_VALUES + 1).collect()
        if len(counts) > MAX_VALUES:
            return page_of_ordered(ordered_table(rest, order), offset, size)
        for row in counts:
            if offset < row["_rows"]:
                break
            offset -= row["_rows"]
        else:
            return rest.limit(0)
        value, rows = row[name], row["_rows"]
        inside = rest.filter(key.eqNullSafe(F.lit(value)))
        if offset + size > rows and value is not None:
            left = rows - offset
            last = [F.col(c).desc_nulls_first() for c in names[place:]]
            behind = rest.filter((key > F.lit(value)) | key.isNull()).orderBy(*order).limit(size - left)
            if left > TOP_K_ROWS or size > TOP_K_ROWS:
                return page_of_ordered(ordered_table(rest.filter((key >= F.lit(value)) | key.isNull()), order), offset, size)
            return inside.orderBy(*last).limit(left).unionByName(behind).orderBy(*order)
        rest = inside
    return rest.limit(max(0, size))


def page_by(df: DataFrame, names: Sequence[str], start: int, size: int) -> DataFrame:
    """Rows ``start`` to ``start + size`` by the columns in order, missing values last.

    Early pages are a top-k that keeps ``start + size`` rows per task. Later ones are found by
    counts, so that no task has to hold all rows before the page. A caller of many deep pages
    keeps one ``ordered_table`` and cuts them with ``page_of_ordered``, or goes on with ``page_after``.
    """
    if start + size <= TOP_K_ROWS:
        return df.orderBy(*[F.col(c).asc_nulls_last() for c in names]).offset(start).limit(size)
    return page_by_counts(df, names, start, size)


def page_names(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """The keys that exist, then every other column as a tie-break."""
    names = [k for k in keys if k in df.columns]
    return names + [c for c in df.columns if c not in names]


def page_flights(df: DataFrame, start: int = 0, size: int = FLIGHTS_PER_PAGE) -> DataFrame:
    """One page of flights; missing sort values come last, missing sort columns are skipped."""
    return page_by(df, page_names(df, PAGE_ORDER), start, size)


@dataclass(frozen=True)
class Cursor:
    """Where a page ended: its last row, and how many rows equal to it have been shown."""

    row: tuple
    shown: int


def _behind(order: Sequence[str], cursor: Cursor) -> Column:
    """Rows at the cursor's row or behind it, missing values last.

    A row is behind if it is greater in one column and equal in all before it. The first column's part
    stands alone as well, for that is what a scan can use to skip files.
    """

    def equal(name: str, value) -> Column:
        return F.col(name).isNull() if value is None else F.col(name) == F.lit(value)

    def beyond(name: str, value) -> Column:
        # Nothing is behind a missing value.
        return F.lit(False) if value is None else (F.col(name) > F.lit(value)) | F.col(name).isNull()

    wanted = F.lit(True)
    for name, value in reversed(list(zip(order, cursor.row))):
        wanted = beyond(name, value) | (equal(name, value) & wanted)
    first, value = order[0], cursor.row[0]
    near = F.col(first).isNull() if value is None else (F.col(first) >= F.lit(value)) | F.col(first).isNull()
    return near & wanted


def page_after(
    df: DataFrame, keys: Sequence[str], cursor: Cursor | None = None, size: int = FLIGHTS_PER_PAGE
) -> tuple[DataFrame, Cursor | None]:
    """The page behind a cursor, and the cursor behind that page; None at the end.

    The order is that of ``page_flights``: the keys, then all other columns, missing values
    last. Whatever the page's number, a task keeps no more rows than a page and those equal to the
    cursor's; nothing is stored. Over files that are clustered by the first key those
    before the cursor are not read. The page is collected, as its last row is the next cursor.
    """
    names = [k for k in keys if k in df.columns] + [c for c in df.columns if c not in keys]
    rest = df if cursor is None else df.filter(_behind(names, cursor))
    skipped = cursor.shown if cursor else 0
    order = [F.col(c).asc_nulls_last() for c in names]
    rows = rest.orderBy(*order).offset(skipped).limit(size).collect()
    page = df.sparkSession.createDataFrame(rows, df.schema)
    if len(rows) < size:
        return page, None
    last = tuple(rows[-1][n] for n in names)
    same = sum(tuple(r[n] for n in names) == last for r in rows)
    before = skipped if cursor and cursor.row == last else 0
    return page, Cursor(last, before + same)


def nav_offsets(
    df: DataFrame,
    start: str = "start",
    end: str = "end",
    total: str = "total",
    increment: int = FLIGHTS_PER_PAGE,
) -> DataFrame:
    """Offsets of the next and previous page and whether each link is shown."""
    first, last, count = F.col(start), F.col(end), F.col(total)
    zero = F.lit(0)
    offsets = {
        "next_bottom": first + increment,
        "next_top": last + increment,
        "previous_bottom": F.greatest(first - increment, zero),
        "previous_top": F.greatest(last - increment, zero),
    }

    def shown(side: str) -> Column:
        bottom, top = F.col(f"{side}_bottom"), F.col(f"{side}_top")
        return (bottom >= 0) & (top > 0) & (count > bottom)

    return df.withColumns(offsets).withColumns(
        {"next_shown": shown("next"), "previous_shown": shown("previous")}
    )
