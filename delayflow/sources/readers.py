"""Batch sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, IntegerType, StringType, StructField, StructType

from delayflow.functions.text import parse_json, parse_or_dead


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table."""
    return spark.read.parquet(path)


def scan_json_schema(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines with a given schema; absent fields are NULL."""
    return spark.read.schema(schema).json(path)


def _cast_text(name: str, kind: DataType) -> Column:
    text = F.col(name)
    if isinstance(kind, DateType):
        # A date may be written as an instant with an offset; its UTC day counts.
        return text.try_cast("timestamp").cast("date")
    if isinstance(kind, IntegerType):
        return text.try_cast("double").try_cast("int")
    return text.try_cast(kind)


def scan_json_inferred_bz2(
    spark: SparkSession, path: str, cast_to: StructType | None = None
) -> DataFrame:
    """JSON lines, decompressed by file suffix.

    Without ``cast_to`` the schema is inferred, which reads all files once more. With
    it the fields are read as text and cast to the declared types in the same pass.
    """
    if cast_to is None:
        return spark.read.json(path)
    as_text = StructType([StructField(f.name, StringType()) for f in cast_to.fields])
    raw = spark.read.schema(as_text).json(path)
    return raw.select(*[_cast_text(f.name, f.dataType).alias(f.name) for f in cast_to.fields])


def scan_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_text_parse_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Text lines parsed to records."""
    return spark.read.text(path).select(parse_json(F.col("value"), schema).alias("r")).select("r.*")


def store_scan_with_range(
    spark: SparkSession, path: str, column: str, low: object, high: object
) -> DataFrame:
    """Rows of a stored table with ``column`` between two bounds, filtered in the scan."""
    stored = spark.read.parquet(path)
    kind = stored.schema[column].dataType
    low_value, high_value = F.lit(low).cast(kind), F.lit(high).cast(kind)
    return stored.filter(F.col(column).between(low_value, high_value))


def scan_json_or_dead(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """JSON lines with a schema, and the lines that are dead letters, as ``raw`` text.

    Both read the files again; cache or store what is used more than once.
    """
    good, dead = parse_or_dead(F.col("value"), schema)
    parsed = spark.read.text(path).select(good.alias("record"), dead.alias("dead"))
    return (
        parsed.filter(F.col("dead").isNull()).select("record.*"),
        parsed.filter(F.col("dead").isNotNull()).select("dead.*"),
    )
