"""Feature vector and train/test split."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.functions import is_finite, keyed_bucket
from perigee.schema import FEATURE_COLUMNS


def assemble(df: DataFrame) -> DataFrame:
    """Adds the `features` vector; rows with a feature that is not finite are skipped (route them aside first)."""
    known = F.lit(True)
    for name in FEATURE_COLUMNS:
        known = known & is_finite(F.col(name))
    return VectorAssembler(
        inputCols=FEATURE_COLUMNS, outputCol="features", handleInvalid="skip"
    ).transform(df.where(known))


def split_keyed(df: DataFrame, key: str = "name", pct: int = 80) -> DataFrame:
    """Adds is_train by a hash of the key: no shuffle, stable on retry, equal in any engine."""
    return df.withColumn("is_train", keyed_bucket(F.col(key)) < pct)


def split_random(df: DataFrame, seed: int, pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """Row-wise random (train, test) split with a fixed seed."""
    train, test = df.randomSplit([float(pct), float(100 - pct)], seed=seed)
    return train, test
