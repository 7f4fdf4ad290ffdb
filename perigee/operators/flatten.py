"""Messages -> flat rows -> dated rows, plus the reject side. Stateless and shuffle-free, so the
same functions serve batch and streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.functions import decode, first_approach, flag_to_label, is_finite, to_day, to_double
from perigee.schema import FEATURE_COLUMNS, LABEL


def encode_label(df: DataFrame, column: str = LABEL) -> DataFrame:
    return df.withColumn(column, flag_to_label(F.col(column)))


def flatten(messages: DataFrame, value: str = "value") -> DataFrame:
    """One flat row of seven columns per message; bad messages and fields become nulls, no row is lost.

    The decoded struct goes through a generator, below which no filter is pushed: conditions on
    decoded columns then test the decoded row, where a plain projection would have Catalyst repeat
    the JSON parse inside every condition.
    """
    first = first_approach(F.col("close_approach_data"))
    size = F.col("estimated_diameter.kilometers")
    flat = messages.select(F.inline(F.array(decode(F.col(value))))).select(
        "name",
        first["close_approach_date"].alias("close_approach_date"),
        size["estimated_diameter_max"].alias("estimated_diameter_km_max"),
        size["estimated_diameter_min"].alias("estimated_diameter_km_min"),
        to_double(first["relative_velocity"]["kilometers_per_second"]).alias("relative_velocity_km_s"),
        to_double(first["miss_distance"]["kilometers"]).alias("miss_distance_km"),
        LABEL,
    )
    return encode_label(flat)


def with_day(flat: DataFrame) -> DataFrame:
    """Adds approach_date, the only date later steps use."""
    return flat.withColumn("approach_date", to_day(F.col("close_approach_date")))


def with_month(dated: DataFrame) -> DataFrame:
    """Adds approach_month (first of month), the partition column of the flat table."""
    return dated.withColumn("approach_month", F.trunc("approach_date", "MM"))


def reject_reason() -> Column:
    """First matching reason why a dated row cannot be trained on or scored; null for a clean row.

    NaN and infinite features count as missing: no model can learn from them.
    """
    no_feature = F.lit(False)
    for name in FEATURE_COLUMNS:
        no_feature = no_feature | ~is_finite(F.col(name))
    return (
        F.when(F.col("name").isNull(), "undecodable")
        .when(F.col("approach_date").isNull(), "no_date")
        .when(no_feature, "no_feature")
    )


def with_reason(dated: DataFrame) -> DataFrame:
    return dated.withColumn("reason", reject_reason())


def clean_rows(dated: DataFrame) -> DataFrame:
    return dated.where(reject_reason().isNull())


def rejects(dated: DataFrame) -> DataFrame:
    return with_reason(dated).where(F.col("reason").isNotNull())


def reject_counts(dated: DataFrame) -> DataFrame:
    return rejects(dated).groupBy("reason").agg(F.count("*").alias("count"))
