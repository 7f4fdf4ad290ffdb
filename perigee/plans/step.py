"""One incremental step: split -> fit or refit -> score -> evaluate -> advance the cursor."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from perigee.functions import day
from perigee.operators.cursor import newer_than
from perigee.operators.features import split_keyed
from perigee.operators.flatten import with_reason
from perigee.operators.model import LinearModel, accumulate, accuracy, as_linear, fit, score_linear
from perigee.operators.newton import Newton
from perigee.plans.state import (
    LATE,
    REJECT,
    TEST,
    TRAIN,
    StatePaths,
    commit,
    latest_batch,
    of_batch,
    read_ledger,
    read_sources,
    read_start,
    read_train,
)
from perigee.schema import DATED_SCHEMA, MAX_FILE_ROWS
from perigee.sources.tables import exists, flat_files, read_flat, rows_of_files

Trainer = Callable[[DataFrame], "LogisticRegressionModel | LinearModel"]  # a Newton starts from the last model

_STAGED_SCHEMA = f"{DATED_SCHEMA}, reason STRING, part STRING"


def _stage(batch: DataFrame, path: str, late_until: date | None) -> DataFrame:
    """Routes every row to train, test, reject or late and writes them in one pass over the batch.

    All later reads of the batch are of this table, so the step neither caches the batch nor
    depends on its source staying the same. Rows are written by the tasks that read them, since a
    shuffle by part would move all of them into four places: at most a file of each part a task,
    which the merge of batches makes few.
    """
    late = F.lit(False) if late_until is None else F.col("approach_date") <= day(late_until)
    part = F.when(late, LATE).when(F.col("reason").isNotNull(), REJECT)
    routed = split_keyed(with_reason(batch)).withColumn("part", part.when(F.col("is_train"), TRAIN).otherwise(TEST))
    writer = routed.drop("is_train", "approach_month").write.mode("overwrite").partitionBy("part")
    writer.option("maxRecordsPerFile", MAX_FILE_ROWS).parquet(path)
    return batch.sparkSession.read.schema(_STAGED_SCHEMA).parquet(path)


def process_batch(
    batch: DataFrame,
    batch_id: int,
    paths: StatePaths,
    trainer: Trainer = fit,
    cursor_from: str = "batch",
    look_back: int | None = None,
    drop_late: bool = False,
) -> Row | None:
    """Processes flat rows as batch `batch_id` and returns its ledger row; None for no rows.

    An id that has its ledger row is done: the row is returned and nothing is written. Rows that can't be
    used, undated ones included, go to the reject part. The cursor moves to the newest date of the whole
    batch, rejected rows included, and never back; cursor_from="test" takes it from the test part instead
    and leaves it where it was when that part is empty. With drop_late, rows dated on or before the cursor
    of the batches before go to the late part and are counted there; otherwise they are used like any other.
    """
    ledger = read_ledger(batch.sparkSession, paths).where(F.col("batch_id") <= batch_id)
    before = latest_batch(ledger)
    if before is not None and before["batch_id"] == batch_id:
        return before
    return _process(batch, batch_id, paths, before, trainer, cursor_from, look_back, drop_late)


def _process(
    batch: DataFrame,
    batch_id: int,
    paths: StatePaths,
    before: Row | None,
    trainer: Trainer = fit,
    cursor_from: str = "batch",
    look_back: int | None = None,
    drop_late: bool = False,
) -> Row | None:
    """process_batch with the ledger row of the batch before, None for the first."""
    if cursor_from not in ("batch", "test"):
        raise ValueError(f"cursor_from must be 'batch' or 'test', not {cursor_from!r}")
    spark = batch.sparkSession
    old_cursor = None if before is None else before["cursor_date"]
    rows = _stage(batch, of_batch(paths.rows, batch_id), old_cursor if drop_late else None)
    train = rows.where(F.col("part") == TRAIN)
    test = rows.where(F.col("part") == TEST)
    in_test = F.col("part") == TEST
    counts = rows.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("part") == REJECT).alias("n_rejected"),
        F.count_if(F.col("part") == LATE).alias("n_late"),
        F.count_if(F.col("part") == TRAIN).alias("n_train"),
        F.count_if(in_test).alias("n_test"),
        F.min("approach_date").alias("first_date"),
        F.max("approach_date" if cursor_from == "batch" else F.when(in_test, F.col("approach_date"))).alias(
            "cursor_date"
        ),
    ).first()
    if counts["n_rows"] == 0:
        return None
    total_train = counts["n_train"] + (0 if before is None else before["total_train"])

    model = None
    share = None
    n_fitted = 0
    if counts["n_train"] > 0:
        old = None
        n_fitted = total_train
        if before is not None:
            old = read_train(spark, paths, before=batch_id, look_back=look_back).select(*train.columns)
            if look_back is not None:
                seen = read_ledger(spark, paths).where(F.col("batch_id").between(batch_id - look_back, batch_id - 1))
                n_fitted = counts["n_train"] + (seen.agg(F.sum("n_train")).first()[0] or 0)
        rows = accumulate(old, train)
        if isinstance(trainer, Newton) and before is not None and before["intercept"] is not None:
            model = trainer(rows, LinearModel(tuple(before["coefficients"]), before["intercept"]))
        else:
            model = as_linear(trainer(rows))
    elif total_train > 0:
        # Nothing new to learn from: a refit would see the same rows as the last one.
        model = LinearModel(tuple(before["coefficients"]), before["intercept"])
    if model is not None:
        scored_path = of_batch(paths.scored, batch_id)
        scored = score_linear(test.drop("reason", "part"), *model)
        scored.write.mode("overwrite").option("maxRecordsPerFile", MAX_FILE_ROWS).parquet(scored_path)
        share = accuracy(spark.read.schema(scored.schema).parquet(scored_path)).first()["accuracy"]

    cursors = [c for c in (counts["cursor_date"], old_cursor) if c is not None]
    return commit(
        spark,
        paths,
        batch_id,
        {
            **counts.asDict(),
            "n_fitted": n_fitted,
            "total_train": total_train,
            "cursor_date": max(cursors, default=None),
            "accuracy": share,
            "coefficients": None if model is None else list(model.coefficients),
            "intercept": None if model is None else model.intercept,
        },
    )


def run_available(
    spark: SparkSession,
    paths: StatePaths,
    initial: date | None = None,
    until: date | None = None,
    **settings: object,
) -> Row | None:
    """One step over all flat rows newer than the cursor, and the others of files that no step has met.

    `initial`, the cursor of the first step, defaults to yesterday by the session's clock; the first call of all
    fixes it for good. Of files that are new since the last step (`sources` lists those met; no names pass through the
    driver) undated rows are rejects, and rows dated after that first cursor but not after the present one are late:
    set aside and counted, never used. A file that lands while a step lists is left to the next; its time tells.
    """
    start = read_start(spark, paths, initial)
    last = latest_batch(read_ledger(spark, paths))
    cursor = start if last is None or last["cursor_date"] is None else last["cursor_date"]
    batch_id = 0 if last is None else last["batch_id"] + 1
    if not exists(spark, paths.flat):
        return None
    new = flat_files(spark, paths.flat).join(read_sources(spark, paths).select("source"), "source", "left_anti")
    new.hint("rebalance").write.mode("overwrite").parquet(of_batch(paths.sources, batch_id))
    new = spark.read.schema("source STRING, modified TIMESTAMP").parquet(of_batch(paths.sources, batch_id))
    since, upto = new.agg(F.min("modified"), F.max("modified")).first()
    flat = read_flat(spark, paths.flat)
    if since is None:
        batch = newer_than(flat, cursor, until)
    else:
        modified = F.col("_metadata.file_modification_time") <= F.lit(upto)
        first = start + timedelta(1)
        before = F.col("approach_date").isNull() | F.col("approach_date").between(day(first), day(cursor))
        # The same by month, which spares the files of all others.
        month = F.col("approach_month")
        months = month.isNull() | month.between(day(first.replace(day=1)), day(cursor.replace(day=1)))
        batch = newer_than(flat.where(modified), cursor, until)
        batch = batch.unionByName(rows_of_files(flat.where(modified & before & months), new, since))
    return _process(batch, batch_id, paths, last, drop_late=True, **settings)


def run_every(
    spark: SparkSession,
    paths: StatePaths,
    seconds: float = 45,
    steps: int | None = None,
    **settings: object,
) -> None:
    """Repeats run_available with a pause after each step, without end unless `steps` is given."""
    done = 0
    while steps is None or done < steps:
        run_available(spark, paths, **settings)
        done += 1
        if steps is None or done < steps:
            time.sleep(seconds)
