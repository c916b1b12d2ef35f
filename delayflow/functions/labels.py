"""Display texts of predicted classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: display texts by class. ---

MINUTES_LABELS = {
    0: "Early (15+ Minutes Early)",
    1: "Slightly Early (0-15 Minute Early)",
    2: "Slightly Late (0-30 Minute Delay)",
    3: "Very Late (30+ Minutes Late)",
}

BATCH_LABELS = {
    0: "On Time (0-15 Minute Delay)",
    1: "Slightly Late (15-60 Minute Delay)",
    2: "Very Late (60+ Minute Delay)",
}

SHORT_LABELS = {
    0: "On time",
    1: "Slight delay",
    2: "Very late",
    3: "Extremely late",
}

# --- End of fixed values. ---


def _lookup(number: Column, labels: dict[int, str]) -> Column:
    chosen = F.lit(None).cast("string")
    for value, label in reversed(labels.items()):
        chosen = F.when(number == value, F.lit(label)).otherwise(chosen)
    return chosen


def decode_label_minutes(prediction: Column) -> Column:
    """Text that fits the delay splits of the classifier; NULL for other classes."""
    return _lookup(prediction.try_cast("double"), MINUTES_LABELS)


def decode_label_batch(prediction: Column) -> Column:
    """Text of the three-class daily report; blank for every other class."""
    return F.coalesce(_lookup(prediction.try_cast("double"), BATCH_LABELS), F.lit(""))


def decode_label_short(prediction: Column) -> Column:
    """Short text; an unknown class is shown as it is."""
    return F.coalesce(
        _lookup(prediction.try_cast("double"), SHORT_LABELS), prediction.cast("string")
    )
