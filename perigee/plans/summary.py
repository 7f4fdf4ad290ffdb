"""Headline figures of a run, read from the ledger alone."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.functions import day


def run_summary(ledger: DataFrame, start: date | None = None) -> DataFrame:
    """One row: start date (given, or the first date seen), end date = cursor - 1 day, points trained
    on, accuracy and low bound (cursor + 1 day) of the latest batch."""
    first = F.min("first_date") if start is None else day(start)
    return ledger.agg(
        first.alias("start_date"),
        F.max("cursor_date").alias("cursor_date"),
        F.max_by("total_train", "batch_id").alias("total_points"),
        F.max_by("accuracy", "batch_id").alias("accuracy"),
    ).select(
        "start_date",
        F.date_sub("cursor_date", 1).alias("end_date"),
        F.date_add("cursor_date", 1).alias("next_from"),
        "total_points",
        "accuracy",
    )
