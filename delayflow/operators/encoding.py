"""Categories as one number each: the mean class of their rows, for forests of any number of values.

A forest over indexes needs a bin and the model a label for every value. Here a value is encoded by
the mean label of its rows, drawn towards the mean of all rows while it has few. The means are a
stored table that is joined, so the model has a fixed width and no list of labels, and none comes to
the driver. A training row is encoded by the rows of the other folds, so its own label does not
leak into its features.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delayflow.operators.joins import join_dimension
from delayflow.operators.learning import (
    FEATURES_COLUMN,
    LABEL_COLUMN,
    PREDICTION_COLUMN,
    TREE_MEMORY_MB,
    bucketize_arrival_delay,
    split_rows,
    spread_rows,
)
from delayflow.operators.projection import derive_route
from delayflow.operators.summaries import accuracy
from delayflow.schemas import CATEGORY_COLUMNS, NUMERIC_FEATURES

FOLDS = 5
# Rows at the mean of all that each value counts for besides its own.
PRIOR_ROWS = 20.0


def _suffixed(column: str) -> str:
    return f"{column}_encoded"


def _mean(total: Column, rows: Column, prior: float) -> Column:
    return (total + F.lit(PRIOR_ROWS * prior)) / (rows + F.lit(PRIOR_ROWS))


def _fold(df: DataFrame, folds: int, seed: int) -> Column:
    """Equal rows are in one fold, so a copy does not tell a row's label."""
    return F.pmod(F.xxhash64(F.lit(seed), *df.columns), F.lit(folds)).cast("int")


def _joined(df: DataFrame, column: str, side: DataFrame, prior: float) -> DataFrame:
    """The encoding of a column joined to the rows; values without one, NULL too, get the prior."""
    keys = [c for c in side.columns if c != _suffixed(column)]
    found = join_dimension(df, side, keys, "left")
    return found.fillna({_suffixed(column): prior})


@dataclass
class TargetEncoding:
    """Where the means of each column's values lie, and the mean of all rows."""

    path: str
    columns: Sequence[str]
    prior: float

    def encode(self, df: DataFrame) -> DataFrame:
        """Rows with an encoded column per category; one join each, broadcast only if found small."""
        for column in self.columns:
            means = df.sparkSession.read.parquet(f"{self.path}/{column}")
            side = means.select(column, _mean(F.col("total"), F.col("rows"), self.prior).alias(_suffixed(column)))
            df = _joined(df, column, side, self.prior)
        return df


def fit_target_encoding(
    df: DataFrame,
    path: str,
    columns: Sequence[str] = CATEGORY_COLUMNS,
    label: str = LABEL_COLUMN,
    folds: int = FOLDS,
    seed: int = 27,
) -> tuple[TargetEncoding, DataFrame]:
    """Store the means under ``path``; also gives the training rows, encoded by the other folds.

    Rows without a label teach nothing and are left out of the training rows.
    """
    labelled = df.filter(F.col(label).isNotNull()).withColumn("_fold", _fold(df, folds, seed))
    prior = labelled.agg(F.coalesce(F.avg(label), F.lit(0.0))).first()[0]
    rows = labelled
    for column in columns:
        # Grouped by value and fold first: a hot value is a few rows after the partial counts.
        parts = labelled.filter(F.col(column).isNotNull()).groupBy(column, "_fold").agg(
            F.sum(label).alias("total"), F.count("*").cast("double").alias("rows")
        )
        parts.write.mode("overwrite").parquet(f"{path}/{column}-folds")
        parts = df.sparkSession.read.parquet(f"{path}/{column}-folds")
        whole = parts.groupBy(column).agg(F.sum("total").alias("total"), F.sum("rows").alias("rows"))
        whole.write.mode("overwrite").parquet(f"{path}/{column}")
        stored = df.sparkSession.read.parquet(f"{path}/{column}").withColumnsRenamed({"total": "_all", "rows": "_of"})
        # Every fold that has the value, less its own rows.
        rest = parts.join(stored, column).select(
            column, "_fold", _mean(F.col("_all") - F.col("total"), F.col("_of") - F.col("rows"), prior).alias(_suffixed(column))
        )
        rows = _joined(rows, column, rest, prior)
    return TargetEncoding(path, list(columns), prior), rows.drop("_fold")


@dataclass
class EncodedForest:
    """A forest over numbers and encoded categories."""

    encoding: TargetEncoding
    model: PipelineModel

    def predict(self, df: DataFrame) -> DataFrame:
        """Requests with route and prediction; numbers that are missing count as unknown."""
        scored = self.model.transform(self.encoding.encode(derive_route(df)))
        inner = [FEATURES_COLUMN, "rawPrediction", "probability", *map(_suffixed, self.encoding.columns)]
        return scored.drop(*inner)

    def save(self, path: str) -> None:
        """Replace the model at ``path``; the means stay where they were fitted."""
        self.model.write().overwrite().save(f"{path}/forest")
        spark = SparkSession.active()
        row = [(self.encoding.path, list(self.encoding.columns), self.encoding.prior)]
        about = spark.createDataFrame(row, "path string, columns array<string>, prior double")
        about.write.mode("overwrite").parquet(f"{path}/encoding")

    @staticmethod
    def load(spark: SparkSession, path: str) -> EncodedForest:
        about = spark.read.parquet(f"{path}/encoding").first()
        return EncodedForest(TargetEncoding(*about), PipelineModel.load(f"{path}/forest"))


def train_encoded_forest(df: DataFrame, path: str, seed: int = 27) -> EncodedForest:
    """Fit means and forest on feature rows, however many routes there are."""
    labelled = bucketize_arrival_delay(derive_route(df))
    encoding, rows = fit_target_encoding(labelled, path, seed=seed)
    inputs = [*NUMERIC_FEATURES, *map(_suffixed, encoding.columns)]
    assembler = VectorAssembler(inputCols=inputs, outputCol=FEATURES_COLUMN, handleInvalid="keep")
    forest = RandomForestClassifier(
        featuresCol=FEATURES_COLUMN, labelCol=LABEL_COLUMN, predictionCol=PREDICTION_COLUMN,
        maxMemoryInMB=TREE_MEMORY_MB, seed=seed,
    ).fit(assembler.transform(spread_rows(rows, [*inputs, LABEL_COLUMN])).select(FEATURES_COLUMN, LABEL_COLUMN))
    return EncodedForest(encoding, PipelineModel([assembler, forest]))


def evaluate_encoded_forest(
    df: DataFrame, path: str, seed: int = 27, held_out: float = 0.2
) -> tuple[EncodedForest, DataFrame]:
    """Fit on one part of the rows and measure accuracy on the rest."""
    fitted, tested = split_rows(df, seed, held_out)
    forest = train_encoded_forest(fitted, path, seed)
    scored = forest.predict(bucketize_arrival_delay(tested))
    return forest, accuracy(scored, LABEL_COLUMN, PREDICTION_COLUMN)
