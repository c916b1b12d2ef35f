"""Message text, JSON and URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Fixed value: a URL whose paging arguments directly follow the question mark.
PAGING_PATTERN = r"(?d)^(.+)\?start=.+&end=.+"

# Fixed value: width of an axis label.
LABEL_WIDTH = 14


def value_to_string(value: Column) -> Column:
    """Message bytes as text."""
    return value.cast("string")


def parse_json(text: Column, schema: StructType) -> Column:
    """JSON text to a struct; malformed text or fields become NULLs."""
    return F.from_json(text, schema, {"mode": "PERMISSIVE"})


def parse_or_dead(text: Column, schema: StructType) -> tuple[Column, Column]:
    """JSON text as a struct, and a struct of its ``raw`` text if it is a dead letter.

    Dead are texts that are no JSON object, and those with a field that is not of its type. The
    second is NULL for good texts, the first for dead ones.
    """
    corrupt = "_corrupt"
    wide = StructType([*schema.fields, StructField(corrupt, StringType())])
    record = F.from_json(text, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    # A text without any field, say an empty one, is not marked, but has no record either.
    dead = record.isNull() | record[corrupt].isNotNull() | ~F.coalesce(F.trim(text).startswith("{"), F.lit(False))
    fields = F.struct(*[record[f.name].alias(f.name) for f in schema.fields])
    return F.when(~dead, fields), F.when(dead, F.struct(text.alias("raw")))


def to_json_record(df: DataFrame, name: str = "value") -> DataFrame:
    """One JSON text column holding all columns; NULL fields are left out."""
    return df.select(F.to_json(F.struct("*")).alias(name))


def truncate_label(text: Column, width: int = LABEL_WIDTH) -> Column:
    """Text cut to ``width`` characters and marked where it was longer."""
    cut = F.concat(F.substring(text, 1, width), F.lit("..."))
    return F.when(F.char_length(text) > width, cut).otherwise(text)


def strip_paging_from_url(url: Column) -> Column:
    """URL without paging arguments that directly follow the question mark."""
    return F.when(url.rlike(PAGING_PATTERN), F.regexp_extract(url, PAGING_PATTERN, 1)).otherwise(url)


def words(text: Column) -> Column:
    """Lower-case words of a text in order."""
    found = F.split(F.lower(text.cast("string")), r"[^\p{L}\p{N}_]+")
    return F.array_remove(found, "")


def search_tokens(text: Column) -> Column:
    """Distinct lower-case words of a text."""
    return F.array_distinct(words(text))
