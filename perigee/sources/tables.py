"""The flat table, partitioned by approach month, and tables of rows to score."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.functions import to_double
from perigee.operators.flatten import with_day, with_month
from perigee.schema import DATED_SCHEMA, FEATURE_COLUMNS, FLAT_TABLE_SCHEMA, FLAT_VIEW, MAX_FILE_ROWS

# The folder of undated rows.
_NO_MONTH = "approach_month=__HIVE_DEFAULT_PARTITION__"


def by_month(flat: DataFrame) -> DataFrame:
    """Flat rows dated and laid out for the table.

    The rebalance hint gathers each month into few files; adaptive execution splits a month that is
    larger than the advisory size, so a hot month is still written by many tasks.
    """
    return with_month(with_day(flat)).hint("rebalance", "approach_month")


def write_flat(flat: DataFrame, path: str) -> None:
    """Batch backfill of a flat table (a table has one writer: this or the stream)."""
    writer = by_month(flat).write.mode("append").partitionBy("approach_month")
    writer.option("maxRecordsPerFile", MAX_FILE_ROWS).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    named = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return named.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(named)


def delete(spark: SparkSession, path: str) -> None:
    named = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    named.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(named, True)


def read_flat(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FLAT_TABLE_SCHEMA).parquet(path)


def landed_files(spark: SparkSession, path: str, names: str = "*") -> DataFrame:
    """source (file path) and modified of each file of a folder: a listing, which opens none of them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", names).load(path)
    return files.select(
        F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_modification_time").alias("modified")
    )


def flat_files(spark: SparkSession, path: str) -> DataFrame:
    return landed_files(spark, path, "*.parquet")


def rows_of_files(table: DataFrame, files: DataFrame, since: datetime) -> DataFrame:
    """The table's rows in those files, the oldest of which was modified at `since`: older files are not opened."""
    place, columns = F.col("_metadata.file_path"), table.columns
    rows = table.where(F.col("_metadata.file_modification_time") >= F.lit(since)).select(*columns, place.alias("source"))
    return rows.join(files.select("source"), "source", "left_semi").select(*columns)


def latest_stored_date(spark: SparkSession, path: str) -> DataFrame:
    """One row: the newest date of the flat table. Folder names tell the newest month, and it alone is read."""
    named = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = named.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = (status.getPath().getName() for status in system.listStatus(named)) if system.exists(named) else ()
    months = sorted((n.partition("=")[2] for n in names if n.startswith("approach_month=") and n != _NO_MONTH), reverse=True)
    flat = read_flat(spark, path) if months else spark.createDataFrame([], FLAT_TABLE_SCHEMA)
    latest = flat.where(F.lit(False)).agg(F.max("approach_date").alias("latest"))
    # A month may hold no rows that are finished; then the one before tells.
    for month in months:
        newest = flat.where(F.col("approach_month") == F.lit(month).cast("date")).agg(F.max("approach_date").alias("latest"))
        if newest.first()["latest"] is not None:
            return newest
    return latest


def register_flat(spark: SparkSession, path: str, name: str = FLAT_VIEW) -> DataFrame:
    """Makes the flat table visible to SQL under a name."""
    flat = read_flat(spark, path)
    flat.createOrReplaceTempView(name)
    return flat


def read_to_score(rows: DataFrame) -> DataFrame:
    """The four inputs as doubles, from text or numbers; text that is no number becomes null."""
    return rows.select(*(to_double(F.col(name).cast("string")).alias(name) for name in FEATURE_COLUMNS))
