"""Column -> Column expressions. All are JVM-side built-ins; none throws on bad input under ANSI mode."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from perigee.schema import DATE_PATTERN, FEATURE_COLUMNS, HAZARDOUS, MESSAGE_SCHEMA, NOT_HAZARDOUS


def decode(value: Column) -> Column:
    """Message bytes or text -> message struct; anything undecodable becomes a struct of nulls."""
    return F.from_json(value.cast("string"), MESSAGE_SCHEMA)


def first_approach(approaches: Column) -> Column:
    """First approach of an object, null for an empty or missing list."""
    return F.get(approaches, F.lit(0))


def to_double(text: Column) -> Column:
    return text.try_cast("double")


def to_day(text: Column) -> Column:
    """Strict yyyy-MM-dd text -> DATE, null for anything else."""
    return F.try_to_date(text, DATE_PATTERN)


def day(value: date) -> Column:
    """DATE literal for any year (F.lit mishandles years before 1000); folded at planning."""
    return F.lit(value.isoformat()).cast("date")


def flag_to_label(flag: Column) -> Column:
    """Boolean flag -> 1.0 / 0.0; a missing flag counts as 0.0."""
    return F.when(flag, 1.0).otherwise(0.0)


def class_text(value: Column) -> Column:
    """1.0 -> hazardous text, any other value and null -> not hazardous."""
    return F.when(value == 1.0, HAZARDOUS).otherwise(NOT_HAZARDOUS)


def keyed_bucket(key: Column) -> Column:
    """Bucket 0-99 of a text key from the leading 32 bits of its md5, the same in any engine."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % 100


def is_finite(value: Column) -> Column:
    """Neither null nor NaN nor infinite; never null itself."""
    return F.coalesce(F.abs(value) < float("inf"), F.lit(False))  # NaN compares as larger than infinity


def linear_margin(coefficients: Sequence[float], intercept: float) -> Column:
    """w . x + b over the four feature columns, null unless all features are finite and the sum is a number."""
    margin, known = F.lit(float(intercept)), F.lit(True)
    for name, weight in zip(FEATURE_COLUMNS, coefficients, strict=True):
        margin = margin + F.col(name) * F.lit(float(weight))
        known = known & is_finite(F.col(name))
    return F.when(known & ~F.isnan(margin), margin)
