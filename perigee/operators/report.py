"""Tables behind the displays: projections, bounded plot grids, comparison counts, exports."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.functions import class_text
from perigee.operators.model import plain_vectors
from perigee.schema import LABEL, MAX_FILE_ROWS, PREDICTED_VALUE, REAL_VALUE


def _with_classes(scored: DataFrame) -> DataFrame:
    return scored.withColumns({
        REAL_VALUE: class_text(F.col(LABEL)),
        PREDICTED_VALUE: class_text(F.col("prediction")),
    })


def display_rows(scored: DataFrame) -> DataFrame:
    return _with_classes(scored).select(
        "name",
        "close_approach_date",
        "estimated_diameter_km_max",
        "estimated_diameter_km_min",
        "relative_velocity_km_s",
        "miss_distance_km",
        REAL_VALUE,
        PREDICTED_VALUE,
    )


def report_rows(scored: DataFrame) -> DataFrame:
    return _with_classes(scored).select(
        "name", REAL_VALUE, PREDICTED_VALUE, "estimated_diameter_km_min", "miss_distance_km"
    )


def scatter_points(display: DataFrame, which: str = REAL_VALUE) -> DataFrame:
    """One point per display row; `which` picks the real or the predicted class as its colour."""
    return display.select(
        F.col("miss_distance_km").alias("x"),
        F.col("estimated_diameter_km_min").alias("y"),
        F.col(which).alias("class"),
    )


def scatter_grid(
    display: DataFrame, width: float, height: float, which: str = REAL_VALUE
) -> DataFrame:
    """Points per grid cell and class: output size follows the grid, not the number of points."""
    points = scatter_points(display, which)
    return points.groupBy(
        F.floor(F.col("x") / width).alias("x_bin"),
        F.floor(F.col("y") / height).alias("y_bin"),
        "class",
    ).agg(F.count("*").alias("count"))


def bounded_grid(
    display: DataFrame,
    columns: int,
    rows: int,
    which: str = REAL_VALUE,
    within: tuple[float, float] | None = None,
    path: str | None = None,
) -> DataFrame:
    """Points per cell and class of a grid of so many columns and rows, whatever the range of the points.

    One pass finds the bounds: the least and greatest values, or with `within` those quantiles (approximately), beyond
    which points count in the outermost cells. Bins start at 0; points without a finite place are in no cell.

    Two passes read the points. With `path` they are first written there, so that rows that cost much are made once.
    """
    far = float("inf")
    points = scatter_points(display, which).where((F.abs("x") < far) & (F.abs("y") < far))
    if path is not None:
        points.write.mode("overwrite").option("maxRecordsPerFile", MAX_FILE_ROWS).parquet(path)
        points = display.sparkSession.read.schema(points.schema).parquet(path)
    if within is None:
        bounds = [f(c) for c in ("x", "y") for f in (F.min, F.max)]
    else:
        bounds = [F.percentile_approx(c, q) for c in ("x", "y") for q in within]
    low_x, high_x, low_y, high_y = points.agg(*(b.alias(f"b{k}") for k, b in enumerate(bounds))).first()

    def bin_of(name: str, low: float | None, high: float | None, n: int) -> Column:
        if low is None or not low < high:
            return F.lit(0).cast("bigint")
        at = F.floor((F.col(name) - low) / (high - low) * n)
        return F.greatest(F.lit(0), F.least(F.lit(n - 1), at)).cast("bigint")

    cells = points.groupBy(
        bin_of("x", low_x, high_x, columns).alias("x_bin"), bin_of("y", low_y, high_y, rows).alias("y_bin"), "class"
    )
    return cells.agg(F.count("*").alias("count"))


def confusion_counts(display: DataFrame) -> DataFrame:
    return display.groupBy(REAL_VALUE, PREDICTED_VALUE).agg(F.count("*").alias("count"))


def export_scored(scored: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Writes every scored column, vectors as arrays, one directory per batch where batches are known
    (few files per batch, a large batch split over several tasks)."""
    kinds = dict(scored.dtypes)
    rows = plain_vectors(scored) if kinds.get("features") == "vector" else scored
    if "batch_id" in kinds:
        rows = rows.hint("rebalance", "batch_id")
    writer = rows.write.format(fmt).mode("overwrite").option("maxRecordsPerFile", MAX_FILE_ROWS)
    (writer.partitionBy("batch_id") if "batch_id" in kinds else writer).save(path)


def export_new(scored: DataFrame, path: str) -> list[int]:
    """Exports, as Parquet, the batches that the target doesn't hold yet, and returns their ids.

    The target lists what it holds in `_exported`, after it is written: a run that fails before writes its batches
    again, over what is there of them.
    """
    spark = scored.sparkSession
    listed = f"{path}/_exported"
    try:
        done = spark.read.schema("batch_id BIGINT").parquet(listed)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        done = spark.createDataFrame([], "batch_id BIGINT")
    # Sent to the tasks: a join that shuffles would put all rows of a batch into one of them.
    rows = scored.join(F.broadcast(done), "batch_id", "left_anti").select(*scored.columns)
    new = sorted(row["batch_id"] for row in rows.select("batch_id").distinct().collect())
    if new:
        writer = rows.hint("rebalance", "batch_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.option("maxRecordsPerFile", MAX_FILE_ROWS).partitionBy("batch_id").parquet(path)
        ids = spark.createDataFrame([(n,) for n in new], "batch_id BIGINT").coalesce(1)
        ids.write.mode("append").parquet(listed)
    return new
