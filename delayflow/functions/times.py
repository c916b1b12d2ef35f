"""Clock times, dates and ISO strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The hour that stands for midnight and the minute of day it is read as (23:59).
MIDNIGHT_HOUR = 24
MIDNIGHT_MINUTE = 1439

SECONDS_PER_DAY = 86_400


def minute_of_day(hhmm: Column) -> Column:
    """Minute of the day of ``HHMM`` digits; hour 24 is 23:59, impossible times are NULL."""
    number = hhmm.try_cast("int")
    hour = (number / 100).cast("int")
    minute = number % 100
    return F.when(hour == MIDNIGHT_HOUR, F.lit(MIDNIGHT_MINUTE)).when(
        (number >= 0) & (hour < MIDNIGHT_HOUR) & (minute < 60), hour * 60 + minute
    )


def hhmm_to_time(hhmm: Column) -> Column:
    """``HHMM`` digits to ``HH:MM``, following ``minute_of_day``."""
    minutes = minute_of_day(hhmm)
    hour, minute = (minutes / 60).cast("int").cast("string"), (minutes % 60).cast("string")
    return F.concat(F.lpad(hour, 2, "0"), F.lit(":"), F.lpad(minute, 2, "0"))


def compose_timestamp(date: Column, hhmm: Column) -> Column:
    """Instant of a UTC date and an ``HHMM`` time.

    Built by arithmetic on days and minutes: no text is parsed and the result does
    not depend on the session time zone.
    """
    days = F.unix_date(date.cast("date")).cast("long")
    return F.timestamp_seconds(days * SECONDS_PER_DAY + minute_of_day(hhmm) * 60)


def overnight_rollover(departure: Column, arrival: Column) -> Column:
    """Arrival moved to the next day where it lies before the departure."""
    return F.when(arrival < departure, arrival + F.expr("INTERVAL 24 HOURS")).otherwise(arrival)


def day_of_year(date: Column) -> Column:
    return F.dayofyear(date.cast("date"))


def month_day_string(month: Column, day: Column) -> Column:
    """``month-day`` without padding; NULL if either part is NULL."""
    return F.concat(month.cast("string"), F.lit("-"), day.cast("string"))


def training_weekday(date: Column) -> Column:
    """Day of week as the training facts count it, Monday = 1."""
    return F.weekday(date) + 1


def request_date_parts(df: DataFrame, date: str = "FlightDate", monday: int = 0) -> DataFrame:
    """Add DayOfYear, DayOfMonth and DayOfWeek; ``monday`` is the number of Monday."""
    day = F.col(date).cast("date")
    return df.withColumns(
        {
            "DayOfYear": F.dayofyear(day),
            "DayOfMonth": F.dayofmonth(day),
            "DayOfWeek": F.weekday(day) + F.lit(monday),
        }
    )


def iso_day_bounds(moment: Column) -> Column:
    """Struct of the ISO date of ``moment`` and the ISO date of the day after."""
    day = moment.cast("date")
    return F.struct(
        F.date_format(day, "yyyy-MM-dd").alias("iso_today"),
        F.date_format(F.date_add(day, 1), "yyyy-MM-dd").alias("iso_tomorrow"),
    )


def request_timestamp() -> Column:
    """Now as an ISO string with microseconds and no zone."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
