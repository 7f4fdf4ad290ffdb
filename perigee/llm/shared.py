"""Folders, folds and stored tables of the operators."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(doc_id.cast("string")) % n


def folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, which all executors share.

    Only a local session, where one machine is all there is, may leave it unset; it gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder()


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="perigee-")


def stored(df: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the shared folder: lost executors repeat nothing before them."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder(df.sparkSession))
    return df.checkpoint(eager=True)


def fresh(columns: list[str], name: str) -> str:
    """A column name like this one that a table doesn't have yet."""
    taken = {c.lower() for c in columns}
    return next(n for n in (name, *(f"{name}_{k}" for k in range(len(columns) + 1))) if n.lower() not in taken)


def parts_left(text: Column, gone: Column, pattern: str | Column) -> Column:
    """A generator of one struct: the parts of the text, the numbers of those that are not gone, and whether gone is null.

    A set difference, so linear in the parts; a generator, lest the split is repeated for every part.
    """
    parts = F.split(F.coalesce(text, F.lit("")), pattern, -1)
    numbers = F.coalesce(gone.cast("array<int>"), F.array().cast("array<int>"))
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), numbers)
    return F.explode(F.array(F.struct(parts.alias("parts"), left.alias("left"), gone.isNull().alias("whole"))))


def rejoined(made: Column, text: Column, separator: str) -> Column:
    """The text of the parts that are left; the text as it was if none are gone."""
    kept = F.array_join(F.transform(made["left"], lambda i: made["parts"][i]), separator)
    return F.when(made["whole"], text).otherwise(kept)


def in_runs(rows: DataFrame, text: list[str], least: int) -> DataFrame:
    """The rows of those runs that together hold so many words.

    A row is a unit: its place and its words. A run is units of one text whose places follow each other; a unit may stand
    there more than once. All units of a text meet in one task, at most as many as it has.
    """
    # In order, units in a row have one difference of place and rank.
    ranked = rows.withColumn("run", F.col("place") - F.dense_rank().over(Window.partitionBy(*text).orderBy("place")))
    run = Window.partitionBy(*text, "run")
    # Repeated rows count once: the words of each place, summed over the places.
    before = F.lag("place").over(run.orderBy("place"))
    counted = ranked.withColumn("once", F.when(before.isNull() | (before < F.col("place")), F.col("words")).otherwise(0))
    return counted.withColumn("held", F.sum("once").over(run)).where(F.col("held") >= least).drop("run", "once", "held")


def narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")


def mapped(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType, rows: int | None = 1024) -> DataFrame:
    """mapInArrow in batches of at most so many rows (None: as they come), which keep copies of long texts small.

    A worker outlives its task, so what Arrow holds in reserve is given back.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if rows is not None:
            batches = (b.slice(at, rows) for b in batches for at in range(0, max(len(b), 1), rows))
        yield from function(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def tasks_to_sum(spark: SparkSession) -> int:
    """In how many tasks partial sums are added before the driver adds theirs: about the root of the partitions."""
    return max(8, isqrt(int(spark.conf.get("spark.sql.shuffle.partitions"))))


def summed(partials: DataFrame, length: int) -> np.ndarray:
    """The sum of the vectors of doubles in column `v` (binary): within a few tasks, then of their results.

    A partial is one vector per partition, so what a task or the driver gets doesn't depend on the rows behind it.
    """
    tasks = tasks_to_sum(partials.sparkSession)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            for value in batch["v"]:
                total += np.frombuffer(value.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

    rows = mapped(partials.select("v").repartition(tasks), add, "v binary").collect()
    return sum((np.frombuffer(row["v"]) for row in rows), np.zeros(length))


def one_vector(values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values.astype(np.float64).tobytes()], pa.binary())], names=["v"])
