"""Stream transformations; all but the correlation are stateless and map-only."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayflow.functions.text import parse_json, parse_or_dead, value_to_string
from delayflow.functions.times import request_date_parts
from delayflow.operators.joins import BROADCAST_BYTES, enrich_distance
from delayflow.operators.learning import predict
from delayflow.operators.projection import flatten_struct
from delayflow.schemas import STREAM_REQUEST_FIELDS, STREAM_REQUEST_SCHEMA
from delayflow.workspace import materialize


def stream_parse_requests(df: DataFrame) -> DataFrame:
    """Message bytes to the twelve typed request columns."""
    record = parse_json(value_to_string(F.col("value")), STREAM_REQUEST_SCHEMA)
    return flatten_struct(df.select(record.alias("flight")), "flight", STREAM_REQUEST_FIELDS)


def stream_parse_or_dead(df: DataFrame) -> DataFrame:
    """The request columns of each message, and ``dead``: its raw text if it is no proper request.

    Messages of other shape, and records with a field that does not parse, are dead letters;
    their request columns are NULL. Hand the rows to ``stream_route``.
    """
    good, dead = parse_or_dead(value_to_string(F.col("value")), STREAM_REQUEST_SCHEMA)
    parsed = df.select(good.alias("flight"), dead.alias("dead"))
    return parsed.select(*[F.col(f"flight.{c}").alias(c) for c in STREAM_REQUEST_FIELDS], "dead")


def stream_score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Requests with their predicted class; the model is loaded once, before the start."""
    return predict(model, df)


def stream_enrich_distance(
    df: DataFrame, dim: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Distance and date parts added to a stream of raw requests."""
    dated = request_date_parts(df, monday=1)
    joined = enrich_distance(dated, dim, broadcast_bytes)
    return joined.withColumn("Distance", F.col("Distance").cast("double"))


def _answers(responses: DataFrame, moment: str) -> DataFrame:
    """Responses with an id and a time, their other columns in one, so that no name clashes."""
    rest = [F.col(c) for c in responses.columns if c not in ("UUID", moment)]
    return responses.filter(F.col("UUID").isNotNull() & F.col(moment).isNotNull()).select(
        F.col("UUID").alias("_answer_to"), F.col(moment).alias("_answered_at"),
        F.struct(*rest, F.lit("OK").alias("status")).alias("_answer"),
    )


def _in_bound(moment: str, bound: str) -> Column:
    asked = F.col(moment)
    answered = F.col("_answered_at")
    return (F.col("UUID") == F.col("_answer_to")) & answered.between(asked, asked + F.expr(f"INTERVAL {bound}"))


def _told(df: DataFrame, requests: DataFrame, responses: DataFrame, moment: str) -> DataFrame:
    """Columns of a request, then those of its first answer, and the status."""
    rest = [c for c in responses.columns if c not in ("UUID", moment)]
    status = F.coalesce(F.col("_first._answer.status"), F.lit("WAIT")).alias("status")
    return df.select(*requests.columns, *[F.col(f"_first._answer.{c}").alias(c) for c in rest], status)


def _first_answer() -> Column:
    """The answer of least time; answers of one time are ordered by their other columns."""
    answer = F.when(F.col("_answer_to").isNotNull(), F.struct("_answered_at", "_answer"))
    return F.min(answer).alias("_first")


def close_correlation(
    requests: DataFrame,
    responses: DataFrame,
    given_out: DataFrame,
    bound: str = "10 minutes",
    moment: str = "Timestamp",
) -> DataFrame:
    """Requests that a correlation has not given out, over stored tables.

    Those are the ones that came later than the watermark allows, and those still held when
    the stream was stopped. Each is given out with its first response within ``bound``, or as
    WAIT; together with ``given_out``, which has all columns of the requests, every request with an
    id and a time is there as often as it was asked.
    """
    pairable = requests.filter(F.col("UUID").isNotNull() & F.col(moment).isNotNull())
    left = materialize(pairable.exceptAll(given_out.select(*requests.columns)), "open")
    asked = left.select("UUID", moment).distinct()
    first = (
        asked.join(_answers(responses, moment), _in_bound(moment, bound))
        .groupBy("UUID", moment)
        .agg(_first_answer())
    )
    return _told(left.join(first, ["UUID", moment], "left"), requests, responses, moment)


def stream_correlate(
    requests: DataFrame,
    responses: DataFrame,
    watermark: str = "1 minute",
    bound: str = "10 minutes",
    moment: str = "Timestamp",
) -> DataFrame:
    """Each request with the first response that came within ``bound`` of it.

    Two stateful steps: an interval join keeps requests and responses until the watermark has
    passed the bound, and a minimum per request is closed when no response can come any more. A response
    before its request, or after the bound, neither counts nor hides another. A request without
    response is given out as WAIT; equal requests are told apart by a random number and come out
    as often as they were asked. Requests without id or time can have no response: they are
    given out at once and kept out of the state, where they would pile up under one key.
    """
    pairable = F.col("UUID").isNotNull() & F.col(moment).isNotNull()
    # A batch that fails is taken again from its source, with the state as it was before.
    pending = requests.filter(pairable).withColumn("_asked", F.expr("uuid()")).withWatermark(moment, watermark)
    answers = _answers(responses.withWatermark(moment, watermark), moment)
    joined = pending.join(answers, _in_bound(moment, bound), "left_outer")
    first = joined.groupBy("_asked", *requests.columns).agg(_first_answer())
    alone = requests.filter(~pairable).withColumn("status", F.lit("WAIT"))
    return _told(first, requests, responses, moment).unionByName(alone, allowMissingColumns=True)
