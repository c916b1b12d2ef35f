"""Target encoding: held-out folds, unseen values, and a forest over very many routes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from delayflow.operators import encoding as E
from delayflow.operators.learning import LABEL_COLUMN, PREDICTION_COLUMN, bucketize_arrival_delay
from delayflow.operators.summaries import accuracy


def test_a_row_is_encoded_without_its_fold(spark, tmp_path):
    df = spark.range(400).select("id", F.concat(F.lit("c"), F.col("id") % 3).alias("c"), (F.col("id") % 4).cast("double").alias("y"))
    df = df.unionByName(spark.createDataFrame([(1000, None, 2.0), (1001, "once", 3.0), (1002, "c0", None)], "id long, c string, y double"))
    encoding, training = E.fit_target_encoding(df, str(tmp_path / "e"), ["c"], "y", folds=4, seed=1)
    known = [r for r in df.withColumn("fold", E._fold(df, 4, 1)).collect() if r.y is not None]
    prior = sum(r.y for r in known) / len(known)
    assert encoding.prior == pytest.approx(prior)

    def mean(rows):
        return (sum(r.y for r in rows) + E.PRIOR_ROWS * prior) / (len(rows) + E.PRIOR_ROWS)

    got = {r.id: r.c_encoded for r in training.collect()}
    assert set(got) == {r.id for r in known}
    for r in known:
        others = [o for o in known if o.c == r.c and o.fold != r.fold] if r.c is not None else []
        assert got[r.id] == pytest.approx(mean(others))
    asked = spark.createDataFrame([(1, "c1"), (2, "new"), (3, None)], "id long, c string")
    given = {r.id: r.c_encoded for r in encoding.encode(asked).collect()}
    assert given == pytest.approx({1: mean([r for r in known if r.c == "c1"]), 2: prior, 3: prior})


def test_two_hundred_thousand_routes_train(spark, tmp_path):
    routes = 200_000
    place = F.pmod(F.xxhash64("id"), F.lit(routes))
    flights = spark.range(2 * routes).select(
        (F.col("id") % 7).cast("double").alias("DepDelay"), F.lit(500.0).alias("Distance"),
        (F.col("id") % 28 + 1).cast("int").alias("DayOfMonth"), (F.col("id") % 7 + 1).cast("int").alias("DayOfWeek"),
        (F.col("id") % 365 + 1).cast("int").alias("DayOfYear"), F.lit("AA").alias("Carrier"),
        F.concat(F.lit("O"), (place / 500).cast("int").cast("string")).alias("Origin"),
        F.concat(F.lit("D"), (place % 500).cast("string")).alias("Dest"),
        # The delay follows the origin alone, which has a class of its own.
        (F.when((place / 500).cast("int") % 3 == 0, -20.0).otherwise(60.0) + F.col("id") % 5).alias("ArrDelay"),
    )
    forest, measured = E.evaluate_encoded_forest(flights, str(tmp_path / "e"))
    labels = bucketize_arrival_delay(flights).groupBy(LABEL_COLUMN).count()
    most = labels.agg(F.max("count") / F.sum("count")).first()[0]
    assert measured.first()["accuracy"] > most + 0.05
    means = spark.read.parquet(str(tmp_path / "e" / "Route"))
    assert means.count() > 150_000
    forest.save(str(tmp_path / "m"))
    again = E.EncodedForest.load(spark, str(tmp_path / "m"))
    scored = bucketize_arrival_delay(flights.limit(1_000))
    same = [accuracy(f.predict(scored), LABEL_COLUMN, PREDICTION_COLUMN).first()[0] for f in (forest, again)]
    assert same[0] == same[1]
    # The model itself has no list of values.
    assert sum(f.stat().st_size for f in (tmp_path / "m").rglob("*") if f.is_file()) < 2_000_000
