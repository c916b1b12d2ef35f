"""Whole jobs under one base path."""

from __future__ import annotations

from pyspark.sql import functions as F

from delayflow.operators import learning as M
from delayflow.plans import jobs as B
from delayflow.registry import QUERIES
from delayflow.registry import jobs as registered
from delayflow.registry.streams import finish, request_lines
from delayflow.registry.tables import distances, enriched, features, flights, view
from delayflow.sources.readers import scan_json_schema
from delayflow.sources.writers import insert_prediction_task, lakehouse_create_or_replace
from delayflow.schemas import FEATURE_SCHEMA
from delayflow.streaming import sinks as K
from delayflow.workspace import new_path
from tests.conftest import rows

DAY = "2024-01-15"


def test_extract_writes_a_sorted_sample(spark, sf_dir):
    base = new_path(spark, "base")
    flights(spark, sf_dir).write.parquet(f"{base}/{B.FACTS}")
    written = scan_json_schema(spark, B.job_extract(spark, base, 0.5), FEATURE_SCHEMA)
    whole = features(spark, sf_dir)
    assert 0.4 < written.count() / whole.count() < 0.6
    assert written.select(*FEATURE_SCHEMA.names).exceptAll(whole.select(*FEATURE_SCHEMA.names)).count() == 0
    days = [r.DayOfYear for r in written.collect()]
    assert days == sorted(days)


def test_train_then_daily_and_stream_prediction(spark, sf_dir):
    base = new_path(spark, "base")
    table = lakehouse_create_or_replace(
        features(spark, sf_dir), "jobs_db", "facts", location=new_path(spark, "lakehouse")
    )
    trained = B.job_train(spark, base, table)
    # Flights without a carrier are trained on too.
    assert [r["column"] for r in trained.nulls.collect()] == ["Carrier"]
    assert 0.4 < trained.accuracy.first()["accuracy"] <= 1
    total = spark.table(table).count()
    assert trained.distribution.agg(F.sum("count")).first()[0] == total
    assert not spark.sparkContext._jsc.sc().getPersistentRDDs().size()

    insert_prediction_task(enriched(spark, sf_dir), f"{base}/{B.TASKS}")
    first = rows(B.job_daily_predict(spark, DAY, base))
    other = B.job_daily_predict(spark, "2024-01-16", base)
    assert other.count() > 0
    assert rows(B.job_daily_predict(spark, DAY, base, trained.model)) == first
    expected = view(spark, sf_dir, "requests").filter(F.col("Timestamp").startswith(DAY)).count()
    assert len(first) == expected

    results = spark.read.parquet(f"{base}/{B.RESULTS}")
    assert results.groupBy("iso_date").count().count() == 2

    running = B.job_stream_predict(
        spark, ("text", {"path": request_lines(spark, sf_dir)}),
        [K.response_writer(f"{base}/responses")], trained.model, f"{base}/checkpoint", K.DRAIN,
    )
    finish(running)
    assert spark.read.text(f"{base}/responses").count() == enriched(spark, sf_dir).count()


def test_extract_compresses_its_records(spark, sf_dir):
    base = new_path(spark, "base")
    flights(spark, sf_dir).write.parquet(f"{base}/{B.FACTS}")
    files = spark.read.text(B.job_extract(spark, base)).inputFiles()
    assert files and all(f.endswith(".json.gz") for f in files)


def test_a_sample_is_sought_among_its_likes_alone(spark, sf_dir, monkeypatch):
    # The rows of the table are not shuffled to find what a handful is like, nor made a second time.
    made = []
    monkeypatch.setattr(registered, "features", lambda *a: made.append(a) or features(*a))
    asked = []
    monkeypatch.setattr(registered, "majority", lambda df: asked.append(df.columns) or 0.0)
    found = rows(QUERIES["job_train"](spark, sf_dir))
    total = features(spark, sf_dir).count()
    assert found == [("accuracy above majority", 1), ("predicted rows", total), ("sampled rows foreign to the table", 0)]
    assert len(made) == 1 and "ArrDelay" in asked[0]


def test_cache_shuffles_only_if_it_is_asked_to(spark):
    few, many = spark.range(0, 100, 1, 2), spark.range(0, 100, 1, 50)
    for df, given, expected in ((few, None, 2), (many, None, 50), (many, 5, 5)):
        cached = B.repartition_cache(df, given)
        assert cached.rdd.getNumPartitions() == expected and cached.count() == 100
        cached.unpersist()


def test_report_shows_text_that_fits_the_classes(spark):
    df = spark.createDataFrame(
        [("2024-01-15T01:00:00", "AA", "2024-01-20", "A", "B", 5.0, 1.0, 3.0)],
        "Timestamp string, Carrier string, FlightDate string, Origin string, Dest string, "
        "Distance double, DepDelay double, Prediction double",
    )
    report = B.batch_results_report(df, DAY)
    assert report.columns == [*B.REPORT_COLUMNS, "Predicted"]
    assert report.first()["Predicted"] == "Very Late (30+ Minutes Late)"


def test_built_requests_can_be_scored(spark, sf_dir):
    form = view(spark, sf_dir, "requests").drop("UUID", "Timestamp")
    built = B.build_request(form.select(*[F.col(c).cast("string") for c in form.columns]), distances(spark, sf_dir))
    assert built.agg(F.count_distinct("UUID")).first()[0] == form.count()
    model = M.train_random_forest(features(spark, sf_dir))
    assert M.predict(model, built).filter("Prediction IS NOT NULL").count() == form.count()
