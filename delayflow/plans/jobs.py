"""Extraction, training, daily and streaming prediction as composed plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from delayflow.functions.labels import decode_label_minutes
from delayflow.functions.times import request_date_parts, request_timestamp
from delayflow.functions.values import request_id
from delayflow.operators import learning
from delayflow.operators.joins import BROADCAST_BYTES, enrich_distance
from delayflow.operators.lookups import requests_in_day
from delayflow.operators.ordering import FEATURE_ORDER, full_order, sample_topk
from delayflow.operators.projection import (
    coerce_request_fields,
    extract_features,
    filter_not_null_delays,
    project_features,
    sample_bernoulli,
)
from delayflow.operators.summaries import null_counts, prediction_distribution
from delayflow.schemas import BATCH_REQUEST_SCHEMA, DAY_COLUMN, NUMERIC_FEATURES
from delayflow.sources.readers import (
    read_text_parse_json,
    scan_catalog_table,
    scan_json_schema,
    scan_parquet,
)
from delayflow.sources.writers import append_results, write_json_single, write_json_text
from delayflow.streaming.sinks import BatchWriter, stream_fanout
from delayflow.streaming.sources import stream_source_requests, with_rate_limit
from delayflow.streaming.supervision import Sink, start_sinks
from delayflow.streaming.transforms import stream_parse_requests, stream_score
from delayflow.workspace import materialize

# --- Fixed values: names of the collections under the base path, and sampling. ---
FACTS = "data/on_time_performance.parquet"
FEATURES = "data/simple_flight_delay_features.json"
TASKS = "data/prediction_tasks"
DAILY_TASKS = "data/prediction_tasks_daily.json"
DAILY_RESULTS = "data/prediction_results_daily.json"
RESULTS = "data/prediction_results"
MODEL = "models/flight_delays"
TRAINING_SAMPLE = 0.1
TRAINING_SEED = 27
REPORT_COLUMNS = [
    "Timestamp", "Carrier", "FlightDate", "Origin", "Dest", "Distance", "DepDelay",
]
# --- End of fixed values. ---


def repartition_cache(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows spread evenly and kept for the passes of a fit; unpersist them afterwards.

    Without a number of partitions they stay where they are: a table is not shuffled just
    to be cached.
    """
    spread = df.repartition(partitions) if partitions else df
    return spread.persist(StorageLevel.MEMORY_AND_DISK)


def job_extract(spark: SparkSession, base: str, fraction: float | None = None) -> str:
    """Raw facts to sorted feature records; gives the path written.

    All facts are used, unless the caller asks for a sample of them by its ``fraction``. The records
    are compressed, as their text is several times the facts.
    """
    projected = project_features(scan_parquet(spark, f"{base}/{FACTS}"))
    if fraction is not None:
        projected = sample_bernoulli(projected, fraction, TRAINING_SEED)
    rows = extract_features(filter_not_null_delays(projected))
    target = f"{base}/{FEATURES}"
    write_json_single(rows, target, full_order(rows, FEATURE_ORDER), compression="gzip")
    return target


@dataclass
class Training:
    """A fitted model and what is worth knowing about it."""

    model: PipelineModel
    path: str
    nulls: DataFrame
    accuracy: DataFrame
    distribution: DataFrame
    sample: DataFrame


def job_train(
    spark: SparkSession,
    base: str,
    table: str,
    seed: int = TRAINING_SEED,
    partitions: int | None = None,
) -> Training:
    """Fit on part of a feature table, measure on the rest, store the model."""
    rows = repartition_cache(scan_catalog_table(spark, table), partitions)
    try:
        model, measured = learning.evaluate_classifier(rows, seed)
        path = f"{base}/{MODEL}"
        model = learning.model_save_load(model, path)
        scored = learning.predict(model, learning.bucketize_arrival_delay(rows))
        # Stored while the rows are still cached; all four are small.
        return Training(
            model=model,
            path=path,
            nulls=materialize(null_counts(rows), "nulls"),
            accuracy=materialize(measured, "accuracy"),
            distribution=materialize(prediction_distribution(scored), "distribution"),
            sample=materialize(sample_topk(scored), "sample"),
        )
    finally:
        rows.unpersist()


def job_daily_predict(
    spark: SparkSession, day: str, base: str, model: PipelineModel | None = None
) -> DataFrame:
    """Fetch a day's requests, score them, load the results; gives the day's results.

    Each step replaces the day's directory, so the job can be run again.
    """
    tasks_path = f"{base}/{DAILY_TASKS}/{DAY_COLUMN}={day}"
    results_path = f"{base}/{DAILY_RESULTS}"
    write_json_text(requests_in_day(scan_parquet(spark, f"{base}/{TASKS}"), day), tasks_path)

    if model is None:
        model = PipelineModel.load(f"{base}/{MODEL}")
    requests = scan_json_schema(spark, tasks_path, BATCH_REQUEST_SCHEMA)
    scored = learning.score_batch(model, requests, results_path, day)

    written = f"{results_path}/{DAY_COLUMN}={day}"
    append_results(read_text_parse_json(spark, written, scored.schema), f"{base}/{RESULTS}", day)
    return scan_parquet(spark, f"{base}/{RESULTS}").filter(F.col(DAY_COLUMN) == F.lit(day).cast("date"))


def job_stream_predict(
    spark: SparkSession,
    source: tuple[str, Mapping[str, str | int]],
    writers: Sequence[BatchWriter],
    model: PipelineModel,
    checkpoint: str,
    trigger: Mapping | None = None,
    rejects: BatchWriter | None = None,
) -> StreamingQuery:
    """Requests from a stream, scored once and handed to all writers, until stopped.

    A request that lacks an id or a number of the feature vector is still scored, as
    such numbers count as unknown; with ``rejects`` it goes there instead. A backlog is
    worked off in micro-batches of bounded size, which the options of the source can set.
    """
    fmt, options = source
    messages = stream_source_requests(spark, fmt, with_rate_limit(fmt, options))
    requests = stream_parse_requests(messages)
    scored = stream_score(model, requests)
    required = ["UUID", *NUMERIC_FEATURES]
    return stream_fanout(scored, writers, checkpoint, trigger, rejects, required)


def job_stream_predict_sinks(
    spark: SparkSession,
    source: tuple[str, Mapping[str, str | int]],
    sinks: Mapping[str, Sink],
    model: PipelineModel,
    checkpoint: str,
) -> dict[str, StreamingQuery]:
    """Requests from a stream, scored and written by one query per sink.

    A slow sink holds no other up and each goes on from its own place after a restart; in return
    the source is read and scored once per sink. Hand the queries to ``supervise``.
    """
    fmt, options = source
    messages = stream_source_requests(spark, fmt, with_rate_limit(fmt, options))
    return start_sinks(stream_score(model, stream_parse_requests(messages)), sinks, checkpoint)


def batch_results_report(df: DataFrame, day: str) -> DataFrame:
    """A day's predictions with the text of the predicted delay."""
    shown = decode_label_minutes(F.col("Prediction")).alias("Predicted")
    return requests_in_day(df, day).select(*REPORT_COLUMNS, shown)


def build_request(
    df: DataFrame,
    dim: DataFrame,
    uuid: Column | None = None,
    stamp: Column | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Form rows to complete requests: types, distance, date parts, time and id.

    The weekday counts as in training. Id and time can be given; generated ids are
    new whenever the rows are computed, so store the requests before using them twice.
    """
    typed = coerce_request_fields(df)
    located = enrich_distance(typed, dim, broadcast_bytes)
    dated = request_date_parts(
        located.withColumn("Distance", F.col("Distance").cast("double")), monday=1
    )
    return dated.withColumns(
        {
            "Timestamp": request_timestamp() if stamp is None else stamp,
            "UUID": request_id() if uuid is None else uuid,
        }
    )
