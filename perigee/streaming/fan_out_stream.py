"""Landed envelopes -> messages, as a stream: each envelope file is read once and each object published once.

The checkpoint knows the files read, so a run opens new ones alone. Messages and rejects are rows of one table,
parted by kind, which its sink's log makes visible batch by batch: what an attempt that failed left behind is in
no batch. On a topic, where writes can repeat, messages carry a key that `once` drops repeats by.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from perigee.plans.state import shuffles_dropped
from perigee.schema import MAX_FILE_ROWS
from perigee.sources.envelopes import fan_out
from perigee.streaming.flat_stream import AVAILABLE_NOW

MESSAGE, REJECT = "message", "reject"
_FANNED = "key STRING, reason STRING, date STRING, value STRING, kind STRING"


def envelope_stream(spark: SparkSession, path: str, fmt: str = "text", options: Mapping[str, str] | None = None) -> DataFrame:
    """Landed envelopes as a stream of (value): whole text files, or a table with a value column."""
    reader = spark.readStream.format(fmt).options(**(options or {}))
    return reader.option("wholetext", True).load(path) if fmt == "text" else reader.schema("value STRING").load(path)


def fanned(envelopes: DataFrame) -> DataFrame:
    """Rows (key, reason, date, value, kind) of a stream of envelopes, of which equal ones count once.

    The state is a digest for each envelope, not for its objects. The key is the digest with the object's number.
    """
    keyed = envelopes.select(F.sha2(F.col("value").cast("binary"), 256).alias("digest"), "value").dropDuplicates(["digest"])
    kind = F.when(F.col("reason").isNull(), MESSAGE).otherwise(REJECT)
    return fan_out(keyed).withColumn("kind", kind)


def start_fan_out(
    spark: SparkSession,
    envelopes: str,
    path: str,
    checkpoint: str,
    fmt: str = "text",
    trigger: Mapping[str, object] = AVAILABLE_NOW,
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Starts publishing landed envelopes to the table at `path`.

    A micro-batch moves whole envelopes to find equal ones; their shuffle files go when it ends.
    """
    writer = fanned(envelope_stream(spark, envelopes, fmt, options)).writeStream.format("parquet").option("path", path)
    writer = writer.option("maxRecordsPerFile", MAX_FILE_ROWS).option("checkpointLocation", checkpoint)
    with shuffles_dropped(spark):  # the stream keeps the settings it starts with
        return writer.option("compression", "zstd").partitionBy("kind").trigger(**trigger).start()


def read_fanned(spark: SparkSession, path: str, kind: str = MESSAGE, stream: bool = False) -> DataFrame:
    """The messages (value BINARY, key) or the rejects (reason, date, value) of such a table."""
    rows = (spark.readStream if stream else spark.read).schema(_FANNED).parquet(path).where(F.col("kind") == kind)
    if kind == MESSAGE:
        return rows.select(F.col("value").cast("binary").alias("value"), "key")
    return rows.select("reason", "date", "value")


def once(messages: DataFrame, key: str = "key", time: str = "timestamp", within: str = "1 hour") -> DataFrame:
    """A stream of messages without those whose key came before, as far apart as `within`: the state is as large as that."""
    return messages.withWatermark(time, within).dropDuplicatesWithinWatermark([key])
