"""Profit regression: linear and random forest, their errors and importances."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sampling import train_test_split
from ..sources.staging import stage
from . import least_squares
from .features import CATEGORICAL, LABEL, NUMERIC, feature_pipeline, laid_out

# Model settings.
TREES = 100
SEED = 42

INPUTS = (*CATEGORICAL, *NUMERIC, LABEL)


def regression_input(
    sales: DataFrame,
    fraction: float = 0.8,
    seed: int = SEED,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """Narrow, split and staged training table.

    Training reads its input several times, so the few columns it needs are
    written once and laid out by their values; the split is taken on whole rows (or
    ``keys``) before the rest is dropped.
    """
    split = train_test_split(sales, fraction, seed, keys)
    numbers = [F.col(c).cast("double").alias(c) for c in (*NUMERIC, LABEL)]
    narrow = split.select("split", *CATEGORICAL, *numbers)
    return laid_out(stage(narrow, "regression").frame)


def part(rows: DataFrame, split: str) -> DataFrame:
    return rows.where(F.col("split") == split).drop("split")


def linear(prediction: str = "prediction") -> LinearRegression:
    return LinearRegression(featuresCol="features", labelCol=LABEL, predictionCol=prediction)


def forest(
    prediction: str = "prediction", trees: int = TREES, seed: int = SEED
) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol="features", labelCol=LABEL, predictionCol=prediction, numTrees=trees, seed=seed
    )


def fit_linear(
    train: DataFrame,
    numeric: Sequence[str] = NUMERIC,
    categorical: Sequence[str] = CATEGORICAL,
) -> PipelineModel:
    return feature_pipeline(linear(), numeric, categorical).fit(train)


def linear_coefficients(model: PipelineModel, numeric: Sequence[str]) -> DataFrame:
    """One row: the intercept and the slope of each numeric feature."""
    fitted = model.stages[-1]
    slopes = [float(c) for c in fitted.coefficients.toArray()[: len(numeric)]]
    names = ", ".join(["intercept double", *[f"{c} double" for c in numeric]])
    spark = SparkSession.active()
    return spark.createDataFrame([(float(fitted.intercept), *slopes)], names)


def fit_forest(train: DataFrame, trees: int = TREES, seed: int = SEED) -> PipelineModel:
    return feature_pipeline(forest(trees=trees, seed=seed)).fit(train)


def fit_least_squares(
    train: DataFrame,
    numeric: Sequence[str] = NUMERIC,
    categorical: Sequence[str] = CATEGORICAL,
) -> least_squares.LinearFit:
    """The linear profit model from one aggregate of the training rows."""
    return least_squares.fit(train, numeric, categorical, LABEL)


def predict_linear(rows: DataFrame) -> DataFrame:
    """The test rows with the prediction of the linear model."""
    return least_squares.predict(part(rows, "test"), fit_least_squares(part(rows, "train")))


def compare_models(rows: DataFrame, trees: int = TREES, seed: int = SEED) -> DataFrame:
    """Test rows with both predictions."""
    train, test = part(rows, "train"), part(rows, "test")
    features = feature_pipeline().fit(train)
    by_trees = forest("forest", trees, seed).fit(features.transform(train).select("features", LABEL))
    by_line = least_squares.predict(test, fit_least_squares(train), "linear")
    return by_trees.transform(features.transform(by_line))


def regression_metrics(
    predictions: DataFrame,
    models: Mapping[str, str],
    label: str = LABEL,
) -> DataFrame:
    """RMSE, MAE and R2 per model in one pass; ``models`` maps name to prediction column."""
    actual = F.col(label).cast("double")
    pairs = F.array(
        *[
            F.struct(
                F.lit(name).alias("model"),
                actual.alias("actual"),
                (actual - F.col(column).cast("double")).alias("error"),
            )
            for name, column in models.items()
        ]
    )
    squares = F.sum(F.col("error") * F.col("error"))
    spread = F.var_pop("actual") * F.count("actual")
    return (
        predictions.select(F.inline(pairs))
        .groupBy("model")
        .agg(
            F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"),
            F.avg(F.abs("error")).alias("mae"),
            (F.lit(1.0) - F.try_divide(squares, spread)).alias("r2"),
        )
    )


def feature_importance(model: PipelineModel, rows: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most important features with their names.

    Names come from the vector's slot metadata, matched by slot number: the
    metadata lists attribute kinds in no slot order.
    """
    groups = model.transform(rows.limit(0)).schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for attrs in groups.values() for a in attrs}
    weights = model.stages[-1].featureImportances.toArray()
    listed = [(names[i], float(w)) for i, w in enumerate(weights)]
    table = rows.sparkSession.createDataFrame(listed, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(k)
