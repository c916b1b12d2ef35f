"""Queries for streams: bounded runs over files, read back as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from delayflow.functions.text import parse_json
from delayflow.registry import query
from delayflow.registry.learning import trained
from delayflow.registry.tables import comparable, distances, enriched, stored, stored_path, view
from delayflow.schemas import STREAM_REQUEST_SCHEMA
from delayflow.sources.readers import scan_json_or_dead
from delayflow.sources.writers import emit_requests
from delayflow.session import state_session
from delayflow.streaming import sinks as K
from delayflow.streaming import sources as S
from delayflow.streaming import transforms as X
from delayflow.streaming import upserts as U
from delayflow.streaming.supervision import start_sinks, supervise
from delayflow.workspace import new_path

_lines: dict[tuple[str, str], str] = {}


def finish(running: StreamingQuery) -> StreamingQuery:
    """Wait for a bounded run to end."""
    running.awaitTermination()
    return running


def request_lines(spark: SparkSession, sf_dir: str) -> str:
    """Folder of published requests, one JSON text per line."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _lines:
        path = new_path(spark, "topic")
        emit_requests(enriched(spark, sf_dir), "text", {"path": path})
        _lines[key] = path
    return _lines[key]


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published requests as a stream of typed columns."""
    source = S.stream_source_requests(spark, "text", {"path": request_lines(spark, sf_dir)})
    return X.stream_parse_requests(source)


def answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requests with a prediction fixed by their number, so that SQL can follow."""
    return parsed(spark, sf_dir).withColumn(
        "Prediction", (F.col("UUID").cast("long") % 4).cast("double")
    )


_REQUEST = """UUID, Origin, Dest, Carrier, FlightNum, FlightDate, DepDelay, Distance, DayOfYear,
    DayOfMonth, DayOfWeek, CAST("Timestamp" AS TIMESTAMP) AS "Timestamp" """
_PARSED = f"SELECT {_REQUEST} FROM enriched"
_CLASS = "CAST(CAST(UUID AS BIGINT) % 4 AS DOUBLE) AS Prediction"
_ANSWERED = f"SELECT {_REQUEST}, {_CLASS} FROM enriched"
_STORED = """SELECT UUID AS uuid, Origin AS origin, Dest AS dest,
    CAST(CAST(UUID AS BIGINT) % 4 AS INT) AS prediction FROM requests"""


def _stored_stream(df: DataFrame, name: str) -> DataFrame:
    """Run a stream to Parquet files and read them."""
    spark = df.sparkSession
    path = new_path(spark, name)
    finish(K.stream_append_mode(df, path, f"{path}-checkpoint", "parquet", K.DRAIN))
    return spark.read.schema(df.schema).parquet(path)


def _drained(df: DataFrame, name: str) -> DataFrame:
    return comparable(_stored_stream(df, name))


def _read_values(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    record = parse_json(F.col("value"), like.schema).alias("r")
    return comparable(spark.read.text(path).select(record).select("r.*"))


@query("stream_source_requests", "SELECT count(*) AS messages, count(DISTINCT UUID) AS ids FROM requests")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = S.stream_source_requests(spark, "text", {"path": request_lines(spark, sf_dir)})
    read = _drained(source, "messages")
    return read.agg(
        F.count("*").alias("messages"),
        F.count_distinct(F.get_json_object("value", "$.UUID")).alias("ids"),
    )


@query("stream_earliest", _PARSED)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = S.stream_earliest(spark, request_lines(spark, sf_dir), max_files_per_trigger=2)
    return _drained(X.stream_parse_requests(source), "earliest")


@query("stream_parse_requests", _PARSED)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drained(parsed(spark, sf_dir), "parsed")


@query("stream_append_mode", _ANSWERED)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drained(answered(spark, sf_dir), "appended")


@query("stream_sink_response", _ANSWERED)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "response")
    rows = answered(spark, sf_dir)
    finish(K.stream_sink_response(rows, "text", {"path": path}, f"{path}-checkpoint", K.DRAIN))
    return _read_values(spark, path, rows)


@query("stream_sink_keyed_upsert", _STORED)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "predictions")
    rows = answered(spark, sf_dir)
    # The whole input is written by two queries: the later one overwrites every key.
    for run in ("first", "second"):
        finish(U.stream_sink_keyed_upsert(rows, path, f"{path}-checkpoint-{run}", K.DRAIN, buckets=8))
    return U.read_upserts(spark, path).drop("timestamp")


@query(
    "stream_upsert_latest",
    """SELECT Carrier, Origin, Dest, FlightNum, CAST("Timestamp" AS TIMESTAMP) AS "Timestamp" FROM
    (SELECT *, row_number() OVER (PARTITION BY Carrier
      ORDER BY CAST("Timestamp" AS TIMESTAMP) DESC, Origin DESC, Dest DESC, FlightNum DESC) AS n
      FROM requests) WHERE n = 1""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "latest")
    # Few files a batch, so that later batches meet what earlier ones have written.
    source = S.stream_earliest(spark, request_lines(spark, sf_dir), max_files_per_trigger=2)
    rows = X.stream_parse_requests(source).select("Carrier", "Timestamp", "Origin", "Dest", "FlightNum")
    order = ["Timestamp", "Origin", "Dest", "FlightNum"]
    finish(U.stream_upsert_latest(rows, path, "Carrier", order, f"{path}-checkpoint", K.DRAIN, buckets=4))
    return comparable(U.read_upserts(spark, path))


@query("stream_sink_debug", _ANSWERED)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = answered(spark, sf_dir)
    path = new_path(spark, "debug")
    finish(K.stream_sink_debug(rows, f"{path}-checkpoint", "parquet", K.DRAIN, {"path": path}))
    return comparable(spark.read.schema(rows.schema).parquet(path))


@query("stream_microbatch_10s", _ANSWERED)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "microbatch")
    rows = answered(spark, sf_dir)
    running = K.stream_microbatch_10s(rows, K.response_writer(path), f"{path}-checkpoint")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return _read_values(spark, path, rows)


@query("stream_skip_empty_batch", _ANSWERED)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "nonempty")
    rows = answered(spark, sf_dir)
    running = K.stream_skip_empty_batch(
        rows, K.response_writer(path), f"{path}-checkpoint", K.DRAIN
    )
    finish(running)
    return _read_values(spark, path, rows)


@query("stream_checkpoint_resume", _ANSWERED)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, path = new_path(spark, "topic"), new_path(spark, "resumed")
    requests = enriched(spark, sf_dir)
    early = F.col("FlightDate") < F.lit("2024-01-15").cast("date")
    # Half the requests are drained, the rest arrives, and a restart takes only that.
    for part in (requests.filter(early), requests.filter(~early)):
        emit_requests(part, "text", {"path": source})
        messages = S.stream_earliest(spark, source)
        rows = X.stream_parse_requests(messages).withColumn(
            "Prediction", (F.col("UUID").cast("long") % 4).cast("double")
        )
        finish(K.stream_checkpoint_resume(rows, path, f"{path}-checkpoint", "parquet"))
    return comparable(spark.read.schema(rows.schema).parquet(path))


@query(
    "stream_fanout",
    f"""SELECT 'response' AS sink, UUID AS uuid, {_CLASS} FROM requests
    UNION ALL SELECT 'store' AS sink, UUID AS uuid, {_CLASS} FROM requests""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "fanout")
    rows = answered(spark, sf_dir)

    def store(batch: DataFrame, batch_id: int) -> None:
        write = U.upsert_writer(f"{path}/store", "uuid", ["timestamp"], buckets=8)
        write(K.stored_prediction(batch), batch_id)

    writers = [K.response_writer(f"{path}/response"), store, K.debug_writer()]
    finish(K.stream_fanout(rows, writers, f"{path}-checkpoint", K.DRAIN))
    responses = _read_values(spark, f"{path}/response", rows)
    predictions = U.read_upserts(spark, f"{path}/store")
    return responses.select(F.lit("response").alias("sink"), F.col("UUID").alias("uuid"), "Prediction").unionByName(
        predictions.select(F.lit("store").alias("sink"), "uuid", F.col("prediction").cast("double").alias("Prediction"))
    )


@query("stream_score", "SELECT count(*) AS requests, count(*) AS scored, count(*) AS as_in_batch FROM requests")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = trained(spark, sf_dir)
    scored = _drained(X.stream_score(model, parsed(spark, sf_dir)), "scored")
    batch = X.stream_score(model, enriched(spark, sf_dir))
    pairs = scored.select("UUID", F.col("Prediction").alias("streamed")).join(
        batch.select("UUID", F.col("Prediction").alias("batch")), "UUID"
    )
    return pairs.agg(
        F.count("*").alias("requests"),
        F.count("streamed").alias("scored"),
        F.count_if(F.col("streamed") == F.col("batch")).alias("as_in_batch"),
    )


@query("stream_enrich_distance", f"SELECT {_REQUEST} FROM enriched")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = parsed(spark, sf_dir).drop("Distance", "DayOfYear", "DayOfMonth", "DayOfWeek")
    return _drained(X.stream_enrich_distance(raw, distances(spark, sf_dir)), "enriched")


def _timed_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses to all requests but errors: a right one up to five minutes later, and strays
    before the request, after the right one, and after the bound.
    """

    def build() -> DataFrame:
        requests = view(spark, sf_dir, "requests").filter("event_type <> 'error'")
        number = F.col("UUID").cast("long")
        sent = F.unix_seconds(F.col("Timestamp").cast("timestamp"))
        late = F.struct((sent + number % 300).alias("at"), (number % 4).cast("double").alias("Prediction"))
        strays = [
            F.when(number % 5 == 1, F.struct((sent - 30).alias("at"), F.lit(-1.0).alias("Prediction"))),
            F.when(number % 7 == 2, F.struct((sent + 400).alias("at"), F.lit(-2.0).alias("Prediction"))),
            F.when(number % 3 == 0, F.struct((sent + 700).alias("at"), F.lit(-3.0).alias("Prediction"))),
        ]
        said = requests.select("UUID", F.explode(F.array(late, *strays)).alias("s")).filter("s IS NOT NULL")
        return said.select("UUID", F.timestamp_seconds("s.at").alias("Timestamp"), "s.Prediction")

    return stored(spark, sf_dir, "timed-responses", build)


@query(
    "stream_correlate",
    """WITH asked AS (SELECT UUID, event_type, CAST("Timestamp" AS TIMESTAMP) AS "Timestamp"
      FROM requests),
    replied AS (SELECT UUID,
      CAST(CAST(UUID AS BIGINT) % 4 AS DOUBLE) AS Prediction FROM asked WHERE event_type <> 'error')
    SELECT a.UUID, a."Timestamp", r.Prediction,
      CASE WHEN r.UUID IS NULL THEN 'WAIT' ELSE 'OK' END AS status
    FROM asked a LEFT JOIN replied r ON a.UUID = r.UUID""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = _timed_responses(spark, sf_dir)
    path = responses.inputFiles()[0].rsplit("/", 1)[0]
    request_lines(spark, sf_dir)
    session = state_session(spark)
    arriving = session.readStream.schema(responses.schema).parquet(path)
    given_out = _stored_stream(X.stream_correlate(parsed(session, sf_dir), arriving), "correlated")
    asked = X.stream_parse_requests(spark.read.text(request_lines(spark, sf_dir)))
    rest = X.close_correlation(asked, responses, given_out)
    names = ["UUID", "Timestamp", "Prediction", "status"]
    return comparable(given_out.select(*names).unionByName(rest.select(*names)))


@query(
    "supervised_sinks",
    f"""SELECT 'response' AS sink, UUID AS uuid, {_CLASS} FROM requests
    UNION ALL SELECT 'store' AS sink, UUID AS uuid, {_CLASS} FROM requests""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "sinks")
    rows = answered(spark, sf_dir)
    sinks = {
        "response": lambda df, checkpoint: K.stream_sink_response(df, "text", {"path": f"{path}/response"}, checkpoint, K.DRAIN),
        "store": lambda df, checkpoint: U.stream_sink_keyed_upsert(df, f"{path}/store", checkpoint, K.DRAIN, buckets=8),
        "debug": lambda df, checkpoint: K.stream_sink_debug(df, checkpoint, "noop", K.DRAIN),
    }
    supervise(start_sinks(rows, sinks, f"{path}/checkpoints"))
    responses = _read_values(spark, f"{path}/response", rows)
    predictions = U.read_upserts(spark, f"{path}/store")
    return responses.select(F.lit("response").alias("sink"), F.col("UUID").alias("uuid"), "Prediction").unionByName(
        predictions.select(F.lit("store").alias("sink"), "uuid", F.col("prediction").cast("double").alias("Prediction"))
    )


# Messages of which a seventh is cut off and a seventh has a weekday that is no number.
_MIXED = """SELECT CAST(UUID AS BIGINT) % 7 AS kind, UUID, Origin, Dest,
  CASE CAST(UUID AS BIGINT) % 7
    WHEN 0 THEN '{"UUID":"' || UUID || '","Origin":"' || Origin
    WHEN 1 THEN '{"UUID":"' || UUID || '","DayOfWeek":"Monday"}'
    ELSE '{"UUID":"' || UUID || '","Origin":"' || Origin || '","Dest":"' || Dest || '","DayOfWeek":3}'
  END AS value FROM <requests>"""
_ROUTED = f"""SELECT 'good' AS route, UUID, Origin, Dest, 3 AS DayOfWeek, NULL AS raw
  FROM ({_MIXED.replace("<requests>", "requests")}) WHERE kind > 1
UNION ALL SELECT 'dead' AS route, NULL, NULL, NULL, NULL, value FROM ({_MIXED.replace("<requests>", "requests")}) WHERE kind <= 1"""


def mixed_lines(spark: SparkSession, sf_dir: str) -> str:
    """Folder of messages some of which are no proper requests."""

    def write(path: str) -> None:
        # Braces are those of JSON but for the table's.
        text = _MIXED.replace("{", "{{").replace("}", "}}").replace("<requests>", "{requests}")
        mixed = spark.sql(text, requests=view(spark, sf_dir, "requests"))
        mixed.select("value").write.text(path)

    return stored_path(spark, sf_dir, "mixed", write)


def _routed(good: DataFrame, dead: DataFrame) -> DataFrame:
    kept = good.select(F.lit("good").alias("route"), "UUID", "Origin", "Dest", "DayOfWeek")
    return kept.unionByName(dead.select(F.lit("dead").alias("route"), "raw"), allowMissingColumns=True)


@query("stream_dead_letters", _ROUTED)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "routed")
    source = S.stream_source_requests(spark, "text", {"path": mixed_lines(spark, sf_dir)})
    rows = X.stream_parse_or_dead(source)
    finish(K.stream_route(rows, [K.table_writer(f"{path}/good")], K.table_writer(f"{path}/dead"), f"{path}-checkpoint", K.DRAIN))
    return _routed(spark.read.parquet(f"{path}/good"), spark.read.parquet(f"{path}/dead"))


@query("scan_json_or_dead", _ROUTED)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(*scan_json_or_dead(spark, mixed_lines(spark, sf_dir), STREAM_REQUEST_SCHEMA))
