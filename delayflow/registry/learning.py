"""Queries for Spark ML operators. SQL cannot follow a model's output, but properties of it."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayflow.operators import encoding as E
from delayflow.operators import learning as M
from delayflow.operators.projection import derive_route
from delayflow.registry import query
from delayflow.registry.tables import comparable, enriched, features, flights, stored
from delayflow.schemas import CATEGORY_COLUMNS, NUMERIC_FEATURES
from delayflow.workspace import materialize, new_path

_models: dict[tuple[str, str], PipelineModel] = {}


def stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "features", lambda: features(spark, sf_dir))


def trained(spark: SparkSession, sf_dir: str) -> PipelineModel:
    """The forest fitted on all features, once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _models:
        _models[key] = M.train_random_forest(stored_features(spark, sf_dir))
    return _models[key]


_ROUTED = "SELECT *, Origin || '-' || Dest AS Route FROM features"


def _rank(column: str) -> str:
    return f"""{column}_rank AS (SELECT {column},
      CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS DOUBLE) AS {column}_index
      FROM routed WHERE {column} IS NOT NULL GROUP BY {column})"""


def _index(column: str) -> str:
    """The rank of a value; that after the last for a missing one."""
    return f"""coalesce({column}_rank.{column}_index,
      (SELECT CAST(count(*) AS DOUBLE) FROM {column}_rank)) AS {column}_index"""


_INDEXED = f"""WITH routed AS ({_ROUTED}), {", ".join(_rank(c) for c in CATEGORY_COLUMNS)},
  indexed AS (SELECT routed.*, {", ".join(map(_index, CATEGORY_COLUMNS))} FROM routed
    {" ".join(f"LEFT JOIN {c}_rank ON routed.{c} = {c}_rank.{c}" for c in CATEGORY_COLUMNS)})
  """


@query(
    "bucketize_arrival_delay",
    """SELECT FlightNum, ArrDelay, CAST(CASE WHEN ArrDelay < -15 THEN 0 WHEN ArrDelay < 0 THEN 1
    WHEN ArrDelay < 30 THEN 2 WHEN ArrDelay >= 30 THEN 3 END AS DOUBLE) AS ArrDelayBucket
    FROM flights""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.bucketize_arrival_delay(flights(spark, sf_dir).select("FlightNum", "ArrDelay"))


@query(
    "string_index",
    _INDEXED
    + """SELECT FlightNum, FlightDate, DepDelay, ArrDelay, Carrier_index, Origin_index, Dest_index,
    Route_index FROM indexed""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = derive_route(stored_features(spark, sf_dir))
    _, indexed = M.string_index(routed)
    return indexed.select(
        "FlightNum", "FlightDate", "DepDelay", "ArrDelay", *[f"{c}_index" for c in CATEGORY_COLUMNS]
    )


@query(
    "string_index_joined",
    _INDEXED
    + """SELECT FlightNum, FlightDate, DepDelay, ArrDelay, Carrier_index, Origin_index, Dest_index,
    Route_index FROM indexed""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    indexed = M.join_index(derive_route(stored_features(spark, sf_dir)))
    return indexed.select(
        "FlightNum", "FlightDate", "DepDelay", "ArrDelay", *[f"{c}_index" for c in CATEGORY_COLUMNS]
    )


_SLOTS = [*NUMERIC_FEATURES, *[f"{c}_index" for c in CATEGORY_COLUMNS]]


@query(
    "assemble_features",
    _INDEXED
    + "SELECT FlightNum, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS slot_{i}" for i, c in enumerate(_SLOTS))
    + " FROM indexed",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, indexed = M.string_index(derive_route(stored_features(spark, sf_dir)))
    slots = vector_to_array(F.col(M.FEATURES_COLUMN)).alias("slots")
    vectors = M.assemble_features(indexed).select("FlightNum", slots)
    return vectors.select(
        "FlightNum", *[F.col("slots")[i].alias(f"slot_{i}") for i in range(len(_SLOTS))]
    )


def majority(rows: DataFrame) -> float:
    """Share of the most frequent class of feature rows, which a model has to beat."""
    labels = M.bucketize_arrival_delay(rows).groupBy(M.LABEL_COLUMN).count()
    return labels.agg(F.max("count") / F.sum("count")).first()[0]


@query(
    "train_random_forest",
    """SELECT Carrier, Origin || '-' || Dest AS Route, count(*) AS flights, count(*) AS classified,
    TRUE AS beats_majority FROM features GROUP BY Carrier, Origin || '-' || Dest""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.bucketize_arrival_delay(stored_features(spark, sf_dir))
    scored = M.predict(trained(spark, sf_dir), rows)
    # Stored, as two summaries are made of it.
    scored = materialize(scored.select("Carrier", "Route", M.PREDICTION_COLUMN, M.LABEL_COLUMN), "predicted")
    found = F.col(M.PREDICTION_COLUMN)
    right = scored.agg(F.avg((found == F.col(M.LABEL_COLUMN)).cast("double"))).first()[0]
    return scored.groupBy("Carrier", "Route").agg(
        F.count("*").alias("flights"), F.count_if(found.isin(0.0, 1.0, 2.0, 3.0)).alias("classified")
    ).withColumn("beats_majority", F.lit(right > majority(stored_features(spark, sf_dir))))


@query("model_save_load", "SELECT count(*) AS requests, count(*) AS same FROM requests")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = trained(spark, sf_dir)
    loaded = M.model_save_load(model, new_path(spark, "model"))
    before = M.predict(model, enriched(spark, sf_dir)).select("UUID", F.col("Prediction").alias("a"))
    after = M.predict(loaded, enriched(spark, sf_dir)).select("UUID", F.col("Prediction").alias("b"))
    return before.join(after, "UUID").agg(
        F.count("*").alias("requests"), F.count_if(F.col("a") == F.col("b")).alias("same")
    )


@query(
    "score_batch",
    """SELECT UUID, Origin || '-' || Dest AS Route, CAST(CAST("Timestamp" AS TIMESTAMP) AS DATE) AS iso_date,
    TRUE AS as_scored FROM requests""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "scored")
    requests = enriched(spark, sf_dir).withColumn("iso_date", F.col("Timestamp").cast("timestamp").cast("date"))
    # Written twice: the second run replaces every day.
    M.score_batch(trained(spark, sf_dir), requests, path)
    scored = M.score_batch(trained(spark, sf_dir), requests, path)
    written = spark.read.schema(scored.schema).json(path)
    direct = scored.select("UUID", F.col(M.PREDICTION_COLUMN).alias("_direct"))
    same = (F.col(M.PREDICTION_COLUMN) == F.col("_direct")) & F.col("_direct").isin(0.0, 1.0, 2.0, 3.0)
    return written.join(direct, "UUID").select("UUID", "Route", "iso_date", same.alias("as_scored"))


@query("evaluate_classifier", "SELECT count(*) > 0 AS measured, TRUE AS beats_majority FROM features")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = M.evaluate_classifier(stored_features(spark, sf_dir))[1]
    found = F.col("accuracy")
    return measured.select(
        found.between(0.0, 1.0).alias("measured"), (found > majority(stored_features(spark, sf_dir))).alias("beats_majority")
    )


@query(
    "regress_arrival_delay",
    """SELECT FlightNum, FlightDate, Origin, Dest, ArrDelay, TRUE AS predicted, TRUE AS held_out_measured
    FROM features""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored_features(spark, sf_dir)
    model, measured = M.evaluate_regression(rows)
    held_out = measured.first()
    predicted = comparable(model.transform(rows))
    return predicted.select(
        "FlightNum", "FlightDate", "Origin", "Dest", "ArrDelay",
        (F.col("Delay").isNotNull() & ~F.isnan("Delay")).alias("predicted"),
        # Delays of the test tables do not follow the features, so it is not asked to beat the mean.
        F.lit(0 < held_out["rows"] < rows.count() and held_out["error"] > 0).alias("held_out_measured"),
    )


@query(
    "target_encoding",
    f"""WITH routed AS ({_ROUTED}),
    labelled AS (SELECT *, CASE WHEN ArrDelay < -15 THEN 0 WHEN ArrDelay < 0 THEN 1
      WHEN ArrDelay < 30 THEN 2 ELSE 3 END AS label FROM routed)
    SELECT Route, count(*) AS flights, round((sum(label) + 20 * (SELECT avg(label) FROM labelled))
      / (count(*) + 20), 9) AS encoded, TRUE AS folds_held_out FROM labelled GROUP BY Route""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = M.bucketize_arrival_delay(derive_route(stored_features(spark, sf_dir)))
    encoding, training = E.fit_target_encoding(labelled, new_path(spark, "encoding"), ["Route"])
    whole = encoding.encode(labelled).groupBy("Route").agg(
        F.count("*").alias("flights"), F.round(F.max("Route_encoded"), 9).alias("encoded")
    )
    # Within a fold all rows of a route have one number, which differs from that of all rows.
    kinds = training.groupBy("Route").agg(F.count_distinct("Route_encoded").alias("kinds"))
    return whole.join(kinds, "Route").select(
        "Route", "flights", "encoded", (F.col("kinds").between(1, E.FOLDS)).alias("folds_held_out")
    )


@query("evaluate_encoded_forest", "SELECT count(*) > 0 AS measured, TRUE AS beats_majority FROM features")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "encoded")
    measured = E.evaluate_encoded_forest(stored_features(spark, sf_dir), path)[1]
    found = F.col("accuracy")
    return measured.select(
        found.between(0.0, 1.0).alias("measured"), (found > majority(stored_features(spark, sf_dir))).alias("beats_majority")
    )
