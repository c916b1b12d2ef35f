"""Spark ML: labels, indexes, feature vectors, training and scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import FeatureHasher, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayflow.operators.joins import join_dimension
from delayflow.operators.ordering import number_rows
from delayflow.operators.projection import derive_route, drop_rename_columns
from delayflow.operators.summaries import accuracy
from delayflow.schemas import CATEGORY_COLUMNS, INDEX_FEATURES, NUMERIC_FEATURES
from delayflow.sources.writers import daily_partition_overwrite
from delayflow.workspace import materialize, width_for

# --- Fixed values: names and parameters of the model. ---
ARRIVAL_SPLITS = (-15.0, 0.0, 30.0)
FEATURES_COLUMN = "Features_vec"
LABEL_COLUMN = "ArrDelayBucket"
PREDICTION_COLUMN = "Prediction"
TREE_MEMORY_MB = 1024
REGRESSION_FEATURES = [
    "Origin", "Dest", "FlightNum", "Distance", "DayOfYear", "DayOfMonth", "DayOfWeek",
]
# --- End of fixed values. ---

# Least bins per feature, as the library has it.
DEFAULT_BINS = 32

# An indexer keeps all its labels in memory, on the driver and in every task.
MAX_CATEGORIES = 100_000

HASHED_FEATURES = 1 << 14

# Rows that one task of a forest's fit holds; the fit keeps some 220 bytes of each.
FIT_ROWS = 500_000

SPLIT_PARTS = 10_000


def arrival_class(delay: Column, splits: Sequence[float] = ARRIVAL_SPLITS) -> Column:
    """Class of a delay: the number of splits at or below it; NULL stays NULL, NaN fails."""
    chosen = F.lit(float(len(splits)))
    for position in reversed(range(len(splits))):
        chosen = F.when(delay < splits[position], F.lit(float(position))).otherwise(chosen)
    not_a_number = F.raise_error(F.lit("a delay is not a number")).cast("double")
    return F.when(F.isnan(delay), not_a_number).when(delay.isNotNull(), chosen)


def bucketize_arrival_delay(
    df: DataFrame, column: str = "ArrDelay", output: str = LABEL_COLUMN
) -> DataFrame:
    """Add the class of the arrival delay, as a plain expression."""
    return df.withColumn(output, arrival_class(F.col(column)))


def category_counts(df: DataFrame, columns: Sequence[str] = CATEGORY_COLUMNS) -> DataFrame:
    """Rows per value of each column, NULLs left out, from one pass.

    Rows are first counted per combination of all columns, so the shuffle and the
    unpivoting see combinations instead of rows.
    """
    combined = df.groupBy(*columns).agg(F.count("*").alias("n"))
    cells = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ]
    cells = combined.select("n", F.inline(F.array(*cells))).filter(F.col("value").isNotNull())
    return cells.groupBy("column", "value").agg(F.sum("n").alias("n"))


def fit_indexer(
    df: DataFrame,
    columns: Sequence[str] = CATEGORY_COLUMNS,
    max_categories: int = MAX_CATEGORIES,
) -> PipelineModel:
    """One indexer per column, most frequent value first, ties in text order.

    Unseen values and NULLs get the index after the last. The library's own fit merges
    the counts of all partitions in one task; here they are grouped by value, and only
    the labels, once found to be few enough for a model, come to the driver.
    """
    counts = materialize(category_counts(df, columns), "categories")
    sizes = counts.groupBy("column").agg(F.count("*").alias("values")).collect()
    large = {r["column"]: r["values"] for r in sizes if r["values"] > max_categories}
    if large:
        raise ValueError(f"too many values to index: {large}, limit {max_categories}")
    labels: dict[str, list[str]] = {c: [] for c in columns}
    for row in counts.orderBy("column", F.col("n").desc(), "value").collect():
        labels[row["column"]].append(row["value"])
    return PipelineModel(
        [
            StringIndexerModel.from_labels(labels[c], c, f"{c}_index", handleInvalid="keep")
            for c in columns
        ]
    )


def string_index(
    df: DataFrame, columns: Sequence[str] = CATEGORY_COLUMNS
) -> tuple[PipelineModel, DataFrame]:
    """Replace categories by their indexes; also gives the fitted indexers."""
    model = fit_indexer(df, columns)
    return model, model.transform(df).drop(*columns)


def category_index(df: DataFrame, columns: Sequence[str] = CATEGORY_COLUMNS) -> DataFrame:
    """Columns column, value and index (double): the rank of each value in its column.

    Most frequent first, ties in text order, from 0. Ranks come from a range-partitioned
    sort of the counts, so any number of values will do and none comes to the driver.
    """
    counts = materialize(category_counts(df, columns), "categories")
    order = [F.col("column"), F.col("n").desc(), F.col("value")]
    ranked = materialize(number_rows(counts, order, "_position"), "ranked")
    firsts = {
        r["column"]: r["first"]
        for r in ranked.groupBy("column").agg(F.min("_position").alias("first")).collect()
    }
    first = F.lit(0)
    for name, position in firsts.items():
        first = F.when(F.col("column") == name, F.lit(position)).otherwise(first)
    index = (F.col("_position") - first).cast("double").alias("index")
    return ranked.select("column", "value", index)


def join_index(df: DataFrame, columns: Sequence[str] = CATEGORY_COLUMNS) -> DataFrame:
    """``string_index`` for any number of values: the index is joined to the rows.

    NULLs get the index after the last, as there. The dictionary of a column is broadcast
    only if it is found to be small.
    """
    index = materialize(category_index(df, columns), "index")
    sizes = {r["column"]: r["n"] for r in index.groupBy("column").agg(F.count("*").alias("n")).collect()}
    for name in columns:
        side = index.filter(F.col("column") == name).select(
            F.col("value").cast(df.schema[name].dataType).alias(name), F.col("index").alias(f"{name}_index")
        )
        df = join_dimension(df, side, [name], "left")
        df = df.fillna({f"{name}_index": float(sizes.get(name, 0))})
    return df.drop(*columns)


def feature_assembler(handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(
        inputCols=NUMERIC_FEATURES + INDEX_FEATURES,
        outputCol=FEATURES_COLUMN,
        handleInvalid=handle_invalid,
    )


def assemble_features(df: DataFrame, handle_invalid: str = "error") -> DataFrame:
    """Numbers and indexes gathered into the feature vector.

    A NULL is an error in training; with ``keep``, as in scoring, it becomes NaN.
    """
    return feature_assembler(handle_invalid).transform(df)


def spread_rows(df: DataFrame, columns: Sequence[str], most: int = FIT_ROWS) -> DataFrame:
    """The columns a fit needs, in as many partitions as keep each at about ``most`` rows.

    A fit keeps its rows and reads them whole on every level, partition by partition; those
    of a scan follow its files, not its rows. Rows are dealt in turn, so equal ones are spread too.
    """
    needed = df.select(*columns)
    rows = needed.count()
    if rows <= most:
        return needed
    return needed.repartition(width_for(df.sparkSession, rows, most))


def train_random_forest(df: DataFrame, seed: int = 27, max_bins: int | None = None) -> PipelineModel:
    """Fit indexer and forest on feature rows; gives one model for requests with a route.

    A forest needs a bin for every value of a category, so ``max_bins`` follows the
    indexer unless it is given.
    """
    labelled = bucketize_arrival_delay(derive_route(df))
    indexer = fit_indexer(labelled)
    if max_bins is None:
        max_bins = max(DEFAULT_BINS, *[len(stage.labels) + 1 for stage in indexer.stages])
    spread = spread_rows(labelled, [*NUMERIC_FEATURES, *CATEGORY_COLUMNS, LABEL_COLUMN])
    vectors = assemble_features(indexer.transform(spread)).select(FEATURES_COLUMN, LABEL_COLUMN)
    forest = RandomForestClassifier(
        featuresCol=FEATURES_COLUMN,
        labelCol=LABEL_COLUMN,
        predictionCol=PREDICTION_COLUMN,
        maxBins=max_bins,
        maxMemoryInMB=TREE_MEMORY_MB,
        seed=seed,
    ).fit(vectors)
    return PipelineModel([*indexer.stages, feature_assembler("keep"), forest])


def model_save_load(model: PipelineModel, path: str) -> PipelineModel:
    """Replace the model at ``path`` and read it back."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Requests with route and prediction and none of the model's inner columns; map-only."""
    return drop_rename_columns(model.transform(derive_route(df)))


def score_batch(model: PipelineModel, df: DataFrame, path: str, day: str | None = None) -> DataFrame:
    """Score requests and replace their days under ``path``.

    With ``day`` the frame is that day's whole input. Without it each request is filed under
    its own ``iso_date``.
    """
    scored = predict(model, df)
    daily_partition_overwrite(scored, path, day)
    return scored


def split_rows(df: DataFrame, seed: int, held_out: float) -> tuple[DataFrame, DataFrame]:
    """Rows to fit on and rows held out.

    A row's hash decides its part: equal rows stay together, so the model is not tested
    on copies of what it has seen, and no sort is needed to make the choice stable.
    """
    place = F.pmod(F.xxhash64(F.lit(seed), *df.columns), F.lit(SPLIT_PARTS))
    tested = place < round(held_out * SPLIT_PARTS)
    return df.filter(~tested), df.filter(tested)


def evaluate_classifier(
    df: DataFrame, seed: int = 27, held_out: float = 0.2
) -> tuple[PipelineModel, DataFrame]:
    """Fit on one part of the rows and measure accuracy on the rest."""
    fitted, tested = split_rows(df, seed, held_out)
    model = train_random_forest(fitted, seed)
    scored = predict(model, bucketize_arrival_delay(tested))
    return model, accuracy(scored, LABEL_COLUMN, PREDICTION_COLUMN)


def evaluate_regression(
    df: DataFrame, seed: int = 27, held_out: float = 0.2
) -> tuple[PipelineModel, DataFrame]:
    """Fit on one part of the rows; one row on the rest: rows, mean square error, variance."""
    fitted, tested = split_rows(df, seed, held_out)
    model, _ = regress_arrival_delay(fitted)
    error = F.pow(F.col("Delay") - F.col("ArrDelay"), F.lit(2))
    return model, model.transform(tested).agg(
        F.count("*").alias("rows"), F.avg(error).alias("error"), F.var_pop("ArrDelay").alias("variance")
    )


def regress_arrival_delay(
    df: DataFrame, num_features: int = HASHED_FEATURES, iterations: int = 25
) -> tuple[PipelineModel, DataFrame]:
    """Arrival delay in minutes from route, flight number, distance and date.

    Hashing keeps the width fixed however many flight numbers there are.
    """
    hasher = FeatureHasher(
        inputCols=REGRESSION_FEATURES, outputCol="hashed", numFeatures=num_features
    )
    regression = LinearRegression(
        featuresCol="hashed",
        labelCol="ArrDelay",
        predictionCol="Delay",
        maxIter=iterations,
        regParam=0.01,
        solver="l-bfgs",
    )
    model = PipelineModel([hasher, regression.fit(hasher.transform(df))])
    return model, model.transform(df).drop("hashed")
