"""Request windows: which date ranges of the feed to ask for, and which are still to be asked for."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.functions import day


def windows_over(span: DataFrame, step_days: int = 2) -> DataFrame:
    """(start, stop) rows -> windows (window_start, window_end) that touch but do not overlap.

    A window covers `step_days` days, both ends included; the first one begins at `start`, the last
    one is the last to begin at or before `stop`.
    """
    step = F.make_interval(days=F.lit(step_days))
    starts = F.explode(F.sequence("start", F.greatest("start", "stop"), step)).alias("window_start")
    return span.where(F.col("start") <= F.col("stop")).select(starts).withColumn(
        "window_end", F.date_add("window_start", step_days - 1)
    )


def feed_windows(spark: SparkSession, start: date, stop: date, step_days: int = 2) -> DataFrame:
    span = spark.range(1).select(day(start).alias("start"), day(stop).alias("stop"))
    return windows_over(span, step_days)


def pending_windows(windows: DataFrame, done: DataFrame) -> DataFrame:
    """Windows without a row in `done` (same window_start), to be fetched next."""
    return windows.join(done.select("window_start").distinct(), "window_start", "left_anti").select(
        "window_start", "window_end"
    )
