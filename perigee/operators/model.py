"""Logistic regression: fit, refit, score, evaluate.

Training is MLlib's. Scoring has two forms with the same output columns and values: `score` runs the
MLlib model, `score_linear` is the same formula as column expressions, which stays in generated
code and works on streams.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.functions import class_text, linear_margin
from perigee.operators.features import assemble
from perigee.schema import FEATURE_COLUMNS, LABEL, PREDICTED_VALUE


class LinearModel(NamedTuple):
    """Weights in FEATURE_COLUMNS order."""

    coefficients: tuple[float, ...]
    intercept: float


def fit(train: DataFrame) -> LogisticRegressionModel:
    """Default logistic regression on flat or assembled rows.

    Only the label and the features are read from `train`. MLlib caches its own packed blocks for
    the iterations, so the input is not persisted here as well.
    """
    rows = train if "features" in train.columns else assemble(train)
    return LogisticRegression(featuresCol="features", labelCol=LABEL).fit(rows.select("features", LABEL))


def refit(old: DataFrame | None, new: DataFrame) -> LogisticRegressionModel:
    """Full refit on everything seen so far."""
    return fit(accumulate(old, new))


def accumulate(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Old and new training rows together, duplicates kept."""
    return new if old is None else old.unionByName(new)


def as_linear(model: LogisticRegressionModel | LinearModel) -> LinearModel:
    if isinstance(model, LinearModel):
        return model
    return LinearModel(tuple(float(w) for w in model.coefficients), float(model.intercept))


def score(df: DataFrame, model: LogisticRegressionModel) -> DataFrame:
    """Adds features, rawPrediction, probability (vectors) and prediction."""
    return model.transform(df if "features" in df.columns else assemble(df))


def score_linear(df: DataFrame, coefficients: Sequence[float], intercept: float) -> DataFrame:
    """Adds features, rawPrediction, probability (arrays) and prediction; features that are not finite score null."""
    margin = F.col("margin")
    hazard = 1.0 / (1.0 + F.exp(-margin))
    return (
        df.withColumn("margin", linear_margin(coefficients, intercept))
        .withColumns({
            "features": F.array(*FEATURE_COLUMNS),
            "rawPrediction": F.when(margin.isNotNull(), F.array(-margin, margin)),
            "probability": F.when(margin.isNotNull(), F.array(1.0 - hazard, hazard)),
            "prediction": (margin > 0).cast("double"),
        })
        .drop("margin")
    )


def plain_vectors(scored: DataFrame) -> DataFrame:
    """MLlib vectors -> arrays, for sinks."""
    return scored.withColumns({
        name: vector_to_array(name) for name in ("features", "rawPrediction", "probability")
    })


def score_table(
    rows: DataFrame, model: LogisticRegressionModel | LinearModel | None
) -> DataFrame:
    """Scores a table of the four inputs: adds prediction and its class text to every row.

    A row with an input that is missing, NaN or infinite gets neither.
    """
    if model is None:
        raise ValueError("no model yet: process a batch before scoring")
    linear = as_linear(model)
    prediction = F.col("prediction")
    return rows.withColumn(
        "prediction", (linear_margin(linear.coefficients, linear.intercept) > 0).cast("double")
    ).withColumn(PREDICTED_VALUE, F.when(prediction.isNotNull(), class_text(prediction)))


def accuracy(scored: DataFrame) -> DataFrame:
    """One row: share of rows whose prediction equals the label, null for no rows."""
    return scored.agg(F.avg((F.col("prediction") == F.col(LABEL)).cast("double")).alias("accuracy"))
