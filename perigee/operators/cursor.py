"""The date cursor: a strict lower bound kept between batch reads (not an event-time watermark)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.functions import day


def newer_than(dated: DataFrame, cursor: date, until: date | None = None) -> DataFrame:
    """Rows dated after the cursor (and, for replay, not after `until`); undated rows drop.

    On the stored flat table the month bounds prune partitions and the day bounds reach Parquet.
    """
    rows = dated.where(F.col("approach_date") > day(cursor))
    if until is not None:
        rows = rows.where(F.col("approach_date") <= day(until))
    if "approach_month" in dated.columns:
        rows = rows.where(F.col("approach_month") >= day(cursor.replace(day=1)))
        if until is not None:
            rows = rows.where(F.col("approach_month") <= day(until.replace(day=1)))
    return rows


def late_rows(dated: DataFrame, cursor: date) -> DataFrame:
    """Dated rows the cursor has already passed."""
    rows = dated.where(F.col("approach_date") <= day(cursor))
    if "approach_month" in dated.columns:
        rows = rows.where(F.col("approach_month") <= day(cursor.replace(day=1)))
    return rows


def latest_date(dated: DataFrame) -> DataFrame:
    """One row: the newest date, null for no dated rows."""
    return dated.agg(F.max("approach_date").alias("latest"))


def latest_rows(dated: DataFrame, n: int = 1) -> DataFrame:
    """The n newest rows, ties broken by name."""
    return dated.orderBy(F.col("approach_date").desc(), F.col("name")).limit(n)
