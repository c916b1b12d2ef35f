"""WARC archives: records of page captures, written and read, and put together again."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delayflow.operators.joins import join_dimension

# Captures in one archive file; a file is read whole by one task.
CAPTURES_PER_FILE = 4_096
# Records besides the capture that one nested row holds; more go to further parts.
COMPANIONS = 1_000
DATE = "2024-01-01T00:00:00Z"

# Fixed values of the archive format.
VERSION = "WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
EOL = "\r\n"

RECORD = T.StructType(
    [
        T.StructField("record_type", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("concurrent_to", T.ArrayType(T.StringType())),
        T.StructField("refers_to", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("head", T.StringType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
    ]
)


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of a string in upper-case base32: each 5 hex digits are 4 characters."""

    def letters(hex_part: Column) -> Column:
        value = F.conv(hex_part, 16, 10).cast("int")
        return F.transform(
            F.array(*[F.lit(s) for s in (15, 10, 5, 0)]),
            lambda s: F.substring(F.lit(BASE32), F.call_function("shiftright", value, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)),
        )

    parts = F.regexp_extract_all(F.sha1(payload), F.lit(".{5}"), F.lit(0))
    return F.array_join(F.flatten(F.transform(parts, letters)), "")


def _record(kind: str | Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record without the two line ends after it. Headers that are NULL are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit(EOL)) for name, value in headers]
    return F.concat(
        F.lit(f"{VERSION}{EOL}WARC-Type: "), kind, F.lit(EOL), F.concat_ws("", *lines),
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(EOL + EOL), block,
    )


def write_captures(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_bytes: int = 0,
    date: str = DATE,
    captures_per_file: int = CAPTURES_PER_FILE,
) -> None:
    """Write a request, a response or revisit, and a metadata record per page under ``path``.

    Of pages with equal payloads of at least ``min_bytes`` that with the least id is the
    response, the others revisit it by its record id; rows that repeat the least id are responses
    too, and what revisits them names no single one of them. Only
    the digests that occur more than once are shared or shuffled; the pages stay where they
    are unless that list is over the bound of a broadcast. Files are gzipped text made by
    Spark's own writer, so any file system works and a lost task is written again. NULL html
    is an empty payload, a NULL url leaves out the header, a NULL id is written as none.
    """
    own = pages.select(
        F.col(f"`{id_col}`").cast("string").alias("id"),
        F.col(f"`{id_col}`").alias("number"),
        F.regexp_replace(F.col(f"`{url_col}`"), r"[\x00-\x20]", "%20").alias("url"),
        F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("payload"),
    ).withColumn("digest", base32_sha1(F.col("payload")))
    rows = own.filter(F.octet_length("payload") >= min_bytes).groupBy("digest", "number").agg(F.count("*").alias("n"))
    least = F.min(F.when(F.col("number").isNotNull(), F.struct("number", "n")))
    repeated = (
        rows.groupBy("digest")
        .agg(least.alias("least"), F.sum("n").alias("n"))
        .filter("n > 1")
        .select("digest", F.col("least.number").alias("first"), (F.col("least.n") == 1).alias("single"))
    )
    joined = join_dimension(own, repeated, ["digest"], "left")
    revisit = (
        (F.octet_length("payload") >= min_bytes)
        & F.col("first").isNotNull()
        & ~F.col("number").eqNullSafe(F.col("first"))
    )
    # The row number tells repeated ids apart; all records of a row are made together. A response
    # that others refer to is named by its digest instead, which they know.
    referred = F.col("single") & F.col("number").eqNullSafe(F.col("first"))
    base = F.concat(
        F.lit("<urn:x-page:"), F.coalesce("id", F.lit("")), F.lit("/"),
        F.when(referred, F.col("digest")).otherwise(F.monotonically_increasing_id().cast("string")),
    )
    named = joined.withColumn("base", base).withColumn("revisit", revisit)
    original = F.concat(F.lit("<urn:x-page:"), F.col("first").cast("string"), F.lit("/"), "digest", F.lit("/capture>"))
    capture = F.concat("base", F.lit("/capture>"))
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "),
        F.octet_length("payload").cast("string"), F.lit(EOL + EOL),
    )
    about = [("WARC-Target-URI", F.col("url")), ("WARC-Date", F.lit(date))]
    host = F.coalesce(F.regexp_extract("url", r"^[a-zA-Z]+://([^/?#]*)", 1), F.lit(""))
    request = _record(
        "request",
        [
            ("WARC-Record-ID", F.concat("base", F.lit("/request>"))),
            ("WARC-Concurrent-To", capture), *about,
            ("Content-Type", F.lit("application/http; msgtype=request")),
        ],
        F.concat(
            F.lit("GET "), F.coalesce("url", F.lit("/")), F.lit(f" HTTP/1.1{EOL}Host: "), host,
            F.lit(EOL + EOL),
        ),
    )
    response = _record(
        F.when(F.col("revisit"), "revisit").otherwise("response"),
        [
            ("WARC-Record-ID", capture), *about,
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
            ("WARC-Profile", F.when(F.col("revisit"), REVISIT)),
            (
                "WARC-Refers-To",
                F.when(F.col("revisit"), original),
            ),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.when(F.col("revisit"), head).otherwise(F.concat(head, "payload")),
    )
    metadata = _record(
        "metadata",
        [
            ("WARC-Record-ID", F.concat("base", F.lit("/metadata>"))),
            ("WARC-Concurrent-To", capture), *about,
            ("Content-Type", F.lit("application/warc-fields")),
        ],
        F.concat(F.lit("via: page "), F.coalesce("id", F.lit("")), F.lit(EOL)),
    )
    lines = named.select(F.explode(F.array(request, response, metadata)).alias("value"))
    (
        lines.write.option("lineSep", EOL + EOL)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", 3 * captures_per_file)
        .text(path)
    )


_HEADER = re.compile(rb"([^\r\n:]+):[ \t]*([^\r\n]*)\r?\n")
_LENGTH = re.compile(rb"(?im)^content-length:[ \t]*(\d+)")


def parse_records(content: bytes) -> Iterator[dict]:
    """Records of one archive, gzipped as a whole or record by record, or plain.

    The length in a header says where a block ends, whatever the block holds. What is left
    after the last whole record is passed over.
    """
    data = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
    at = 0
    while True:
        at = data.find(b"WARC/", at)
        end = data.find(b"\r\n\r\n", at)
        if at < 0 or end < 0:
            return
        start = data.find(b"\n", at) + 1
        headers: dict[str, list[str]] = {}
        for name, value in _HEADER.findall(data[start : end + 2]):
            headers.setdefault(name.decode().lower(), []).append(value.decode("utf-8", "replace"))
        size = int(headers.get("content-length", ["0"])[0])
        block = data[end + 4 : end + 4 + size]
        at = end + 4 + size
        if len(block) < size:
            return
        yield _parsed(headers, block)


def _parsed(headers: dict[str, list[str]], block: bytes) -> dict:
    def one(name: str) -> str | None:
        return headers.get(name, [None])[0]

    kind, head, payload = one("warc-type"), b"", block
    if (one("content-type") or "").startswith("application/http"):
        head, mark, payload = block.partition(b"\r\n\r\n")
    size, digest = len(payload), (one("warc-payload-digest") or "").removeprefix("sha1:")
    if kind == "revisit":
        stated = _LENGTH.search(head)
        payload, size = b"", int(stated[1]) if stated else size
    elif kind == "response":
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return {
        "record_type": kind,
        "record_id": one("warc-record-id"),
        "concurrent_to": headers.get("warc-concurrent-to", []),
        "refers_to": one("warc-refers-to"),
        "target_uri": one("warc-target-uri"),
        "date": one("warc-date"),
        "head": head.decode("utf-8", "replace"),
        "payload": payload,
        "payload_bytes": size,
        "payload_digest": digest or None,
    }


def read_records(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """All records of the archives under ``path``, one row each.

    Payload lengths and digests are computed from what was read; those of a revisit, whose
    payload is elsewhere, are the ones it states. A folder without archives gives no rows.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .load(path)
        .select("content")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for record in parse_records(content.as_py()):
                    size += len(record["payload"])
                    if not keep_payload:
                        record["payload"] = None
                    held.append(record)
                    if len(held) == 1_000 or size > 8 * 1024 * 1024:
                        yield _batch(held)
                        held, size = [], 0
                yield _batch(held)

    return files.mapInArrow(run, RECORD)


def _batch(records: list[dict]) -> pa.RecordBatch:
    kinds = {"ArrayType": pa.list_(pa.string()), "BinaryType": pa.binary(), "LongType": pa.int64()}
    fields = [(f.name, kinds.get(type(f.dataType).__name__, pa.string())) for f in RECORD.fields]
    return pa.RecordBatch.from_pylist(records, schema=pa.schema(fields))


def assemble(records: DataFrame, companions: int = COMPANIONS) -> DataFrame:
    """One nested row per capture: the response or revisit, its requests and its metadata.

    Records belong to a capture that they name as concurrent to them, or that names them.
    A capture with more than ``companions`` other records gets further rows, numbered by
    ``part``, and each of them has the capture; nothing is left out and no task gathers an
    unbounded group. A record that belongs to no capture is not part of a transaction and is
    left to ``records``. Repeated records are kept as often as they occur.
    """
    fields = F.struct(*[F.col(c) for c in RECORD.names])
    is_capture = F.col("record_type").isin("response", "revisit")
    captures = records.filter(is_capture).withColumn("root", F.col("record_id"))
    others = records.filter(F.col("record_type").isin("request", "metadata"))
    named = others.select("*", F.explode(F.array_distinct("concurrent_to")).alias("root"))
    back = captures.filter(F.size("concurrent_to") > 0).select(
        "root", F.explode(F.array_distinct("concurrent_to")).alias("record_id")
    )
    answered = join_dimension(others, back, ["record_id"], "inner").select(*named.columns)
    joined = named.unionByName(answered)
    large = (
        joined.groupBy("root").agg(F.count("*").alias("n")).filter(F.col("n") > companions)
        .select("root", F.ceil(F.col("n") / companions).cast("int").alias("parts"))
    )
    spread = F.pmod(F.xxhash64("record_id", F.monotonically_increasing_id()), F.coalesce("parts", F.lit(1)))
    dealt = join_dimension(joined, large, ["root"], "left").select(
        "root", spread.cast("int").alias("part"), F.col("record_type").alias("kind"), fields.alias("record")
    )
    heads = join_dimension(captures, large, ["root"], "left").select(
        "root",
        F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"),
        F.lit("capture").alias("kind"),
        fields.alias("record"),
    )
    record = F.col("record")
    return (
        heads.unionByName(dealt)
        .groupBy("root", "part")
        .agg(
            F.collect_list(F.when(F.col("kind") == "capture", record)).alias("captures"),
            F.collect_list(F.when(F.col("kind") == "request", record)).alias("requests"),
            F.collect_list(F.when(F.col("kind") == "metadata", record)).alias("metadata"),
        )
        .select(F.explode("captures").alias("capture"), "part", "requests", "metadata")
    )


def page_of(urn: Column) -> Column:
    """Page id in a record id or a reference; NULL if it has none."""
    return F.nullif(F.regexp_extract(urn, r"^<urn:x-page:([^/>]*)", 1), F.lit(""))
