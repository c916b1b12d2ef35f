"""Indexing, training, persistence and scoring."""

from __future__ import annotations

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import Bucketizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from delayflow.operators import learning as M
from delayflow.operators.projection import derive_route
from delayflow.registry.tables import enriched, features
from delayflow.workspace import materialize, new_path
from tests.conftest import SF_DIR, rows


@pytest.fixture(scope="module")
def facts(spark):
    return materialize(features(spark, SF_DIR), "facts")


@pytest.fixture(scope="module")
def model(facts):
    return M.train_random_forest(facts)


def test_classes_equal_the_bucketizer(facts):
    infinity = float("inf")
    bucketizer = Bucketizer(
        splits=[-infinity, *M.ARRIVAL_SPLITS, infinity], inputCol="ArrDelay", outputCol="expected"
    )
    both = bucketizer.transform(M.bucketize_arrival_delay(facts))
    assert both.filter(F.col("expected") != F.col(M.LABEL_COLUMN)).count() == 0


def test_index_is_rank_by_frequency_then_text(spark):
    df = spark.createDataFrame([(x,) for x in "bacab"], "x string")
    indexer, indexed = M.string_index(df, ["x"])
    assert list(indexer.stages[0].labels) == ["a", "b", "c"]
    assert rows(indexed.groupBy("x_index").count()) == [(0.0, 2), (1.0, 2), (2.0, 1)]
    unseen = indexer.transform(spark.createDataFrame([("z",), (None,)], "x string"))
    assert [r.x_index for r in unseen.collect()] == [3.0, 3.0]


def test_index_equals_the_librarys_fit(facts):
    routed = derive_route(facts)
    expected = StringIndexer(
        inputCols=M.CATEGORY_COLUMNS, outputCols=M.INDEX_FEATURES, stringOrderType="frequencyDesc"
    ).fit(routed)
    found = [list(stage.labels) for stage in M.fit_indexer(routed).stages]
    assert found == [list(x) for x in expected.labelsArray]


def test_indexing_refuses_more_values_than_fit_in_memory(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("x"))
    with pytest.raises(ValueError, match="too many"):
        M.fit_indexer(df, ["x"], max_categories=1000)


def test_any_number_of_values_is_indexed_by_a_join(spark):
    many = spark.range(200_000).select(F.format_string("%06d", "id").alias("x"))
    df = many.unionByName(spark.createDataFrame([("000007",), (None,)], "x string")).withColumn("y", F.col("x"))
    placed = M.join_index(df, ["y"])
    assert placed.count() == 200_002
    # The repeated value comes first; those before it in text order move up by one.
    number = F.col("x").cast("double")
    wanted = F.when(number == 7, 0.0).when(number < 7, number + 1).otherwise(number)
    wrong = placed.filter(~F.col("y_index").eqNullSafe(F.coalesce(wanted, F.lit(200_000.0))))
    assert wrong.count() == 0


def test_joined_index_equals_the_indexer(facts):
    routed = derive_route(facts)
    assert rows(M.join_index(routed)) == rows(M.string_index(routed)[1].select(M.join_index(routed).columns))


def test_regression_is_measured_on_held_out_rows(facts):
    # The delays of the test tables are noise to the features; these follow them.
    place = F.ascii(F.substring("Origin", 3, 1)) - F.ascii(F.substring("Dest", 3, 1))
    known = facts.withColumn("ArrDelay", F.col("Distance") / 20 + place)
    held_out = M.evaluate_regression(known)[1].first()
    assert 0 < held_out.rows < facts.count() / 3
    assert held_out.error < held_out.variance / 2


def test_scored_requests_are_filed_under_their_own_day(spark, model, sf_dir):
    path = new_path(spark, "days")
    requests = enriched(spark, sf_dir).withColumn("iso_date", F.to_date("Timestamp"))
    M.score_batch(model, requests, path)
    found = spark.read.json(path).groupBy("iso_date").count()
    assert rows(found.select(F.col("iso_date").cast("date"), "count")) == rows(requests.groupBy("iso_date").count())


def test_vector_order_and_missing_numbers(spark):
    values = {c: float(i) for i, c in enumerate(M.feature_assembler().getInputCols())}
    df = spark.createDataFrame([values])
    slots = M.assemble_features(df).select(vector_to_array(M.FEATURES_COLUMN)).first()[0]
    assert slots == [float(i) for i in range(9)]
    gap = df.withColumn("DepDelay", F.lit(None).cast("double"))
    kept = M.assemble_features(gap, "keep").select(vector_to_array(M.FEATURES_COLUMN)).first()[0]
    assert kept[0] != kept[0] and kept[1:] == slots[1:]
    with pytest.raises(Exception):
        M.assemble_features(gap).collect()


def test_model_is_the_same_after_reload(spark, model, sf_dir):
    requests = enriched(spark, sf_dir)
    loaded = M.model_save_load(model, new_path(spark, "model"))
    again = M.model_save_load(loaded, new_path(spark, "model"))
    expected = rows(M.predict(model, requests).select("UUID", "Prediction"))
    assert rows(M.predict(again, requests).select("UUID", "Prediction")) == expected


def test_training_is_repeatable(spark, facts, model, sf_dir):
    other = M.train_random_forest(facts)
    requests = enriched(spark, sf_dir)
    assert rows(M.predict(other, requests).select("UUID", "Prediction")) == rows(
        M.predict(model, requests).select("UUID", "Prediction")
    )


def test_scoring_keeps_requests_and_is_map_only(spark, model, sf_dir):
    requests = enriched(spark, sf_dir)
    scored = M.predict(model, requests)
    assert scored.columns == [*requests.columns, "Route", "Prediction"]
    assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()
    # Carriers C14 and C15 and airports A25 and A26 do not occur in training.
    assert scored.filter("Carrier IN ('C14', 'C15') AND Prediction IS NULL").count() == 0
    assert scored.count() == requests.count()


def test_beats_the_majority_class(facts):
    model, measured = M.evaluate_classifier(facts)
    accuracy = measured.first()["accuracy"]
    labels = M.bucketize_arrival_delay(facts).groupBy(M.LABEL_COLUMN).count()
    majority = labels.agg(F.max("count") / F.sum("count")).first()[0]
    assert accuracy > majority + 0.1
    scored = M.predict(model, M.bucketize_arrival_delay(facts))
    evaluator = MulticlassClassificationEvaluator(
        predictionCol="Prediction", labelCol=M.LABEL_COLUMN, metricName="accuracy"
    )
    ours = M.accuracy(scored, M.LABEL_COLUMN, "Prediction").first()["accuracy"]
    assert evaluator.evaluate(scored) == pytest.approx(ours)


def test_score_batch_replaces_the_day(spark, model, sf_dir):
    path = new_path(spark, "scored")
    requests = enriched(spark, sf_dir)
    M.score_batch(model, requests, path, "2024-01-01")
    M.score_batch(model, requests.limit(10), path, "2024-01-01")
    assert spark.read.json(path).count() == 10


def test_regression_is_better_than_the_mean(facts):
    model, predicted = M.regress_arrival_delay(facts)
    assert isinstance(model, PipelineModel) and "hashed" not in predicted.columns
    errors = predicted.agg(
        F.avg(F.pow(F.col("Delay") - F.col("ArrDelay"), 2)), F.var_pop("ArrDelay")
    ).first()
    assert errors[0] < errors[1]


def test_route_of_requests(spark):
    df = spark.createDataFrame([("A", "B")], "Origin string, Dest string")
    assert derive_route(df).first()["Route"] == "A-B"


def test_a_fit_spreads_rows_that_came_in_one_partition(spark, facts, monkeypatch):
    # Equal rows too: no task of a fit holds more than its share.
    one = facts.limit(1).crossJoin(spark.range(0, 2000, 1, 1)).drop("id")
    spread = M.spread_rows(one.coalesce(1), one.columns, 100)
    sizes = spread.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    assert sizes[0] <= 120 and sizes[1] == 2000
    assert M.spread_rows(facts, ["DepDelay"], 10**9).rdd.getNumPartitions() == facts.rdd.getNumPartitions()
    seen = []
    forest = M.RandomForestClassifier.fit
    monkeypatch.setattr(M.RandomForestClassifier, "fit", lambda f, df: seen.append(df) or forest(f, df))
    monkeypatch.setattr(M.spread_rows, "__defaults__", (50,))
    total = facts.count()
    M.train_random_forest(facts.coalesce(1))
    assert seen[0].count() == total and seen[0].rdd.getNumPartitions() == -(-total // 50)
