"""Record layouts."""

from __future__ import annotations

from pyspark.sql.types import StructType


def _record(**fields: str) -> StructType:
    record = StructType()
    for name, kind in fields.items():
        record.add(name, kind)
    return record


# --- Fixed values: field names, types and parameters of the data contract. ---

# Training facts.
FEATURE_SCHEMA = _record(
    ArrDelay="double",
    CRSArrTime="timestamp",
    CRSDepTime="timestamp",
    Carrier="string",
    DayOfMonth="integer",
    DayOfWeek="integer",
    DayOfYear="integer",
    DepDelay="double",
    Dest="string",
    Distance="double",
    FlightDate="date",
    FlightNum="string",
    Origin="string",
)

# Requests of the daily batch.
BATCH_REQUEST_SCHEMA = _record(
    Carrier="string",
    DayOfMonth="integer",
    DayOfWeek="integer",
    DayOfYear="integer",
    DepDelay="double",
    Dest="string",
    Distance="double",
    FlightDate="date",
    FlightNum="string",
    Origin="string",
    Timestamp="timestamp",
)

# Requests on the stream.
STREAM_REQUEST_SCHEMA = _record(
    Origin="string",
    FlightNum="string",
    DayOfWeek="integer",
    DayOfYear="integer",
    DayOfMonth="integer",
    Dest="string",
    DepDelay="double",
    Prediction="string",
    Timestamp="timestamp",
    FlightDate="date",
    Carrier="string",
    UUID="string",
    Distance="double",
    Carrier_index="double",
    Origin_index="double",
    Dest_index="double",
    Route_index="double",
)

# Stream fields carried on to scoring.
STREAM_REQUEST_FIELDS = [
    "Origin", "FlightNum", "DayOfWeek", "DayOfYear", "DayOfMonth", "Dest",
    "DepDelay", "Timestamp", "FlightDate", "Carrier", "UUID", "Distance",
]

# Form fields of a request and the type each is parsed to.
REQUEST_FORM_TYPES = {
    "DepDelay": "double",
    "Carrier": "string",
    "FlightDate": "string",
    "Dest": "string",
    "FlightNum": "string",
    "Origin": "string",
}

# Categories that are indexed, and the slots of the feature vector.
CATEGORY_COLUMNS = ["Carrier", "Origin", "Dest", "Route"]
NUMERIC_FEATURES = ["DepDelay", "Distance", "DayOfMonth", "DayOfWeek", "DayOfYear"]
INDEX_FEATURES = [f"{name}_index" for name in CATEGORY_COLUMNS]

# Column that holds the day of a daily directory.
DAY_COLUMN = "iso_date"

# Page sizes.
FLIGHTS_PER_PAGE = 15
AIRPLANES_PER_PAGE = 5

# --- End of fixed values. ---
