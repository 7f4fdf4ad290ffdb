"""Messages: one object per row in a binary `value` column, on a topic or in a directory.

`fmt` and `options` go to Spark unchanged, so a topic is fmt="kafka" with the connector's own
options; directories of "parquet" (any bytes, null messages included) or "text" (one message per
line) need no connector.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.schema import MAX_FILE_ROWS

FILE_FORMATS = ("parquet", "text", "json", "orc")
# Sources that bring their own columns; any other needs the one below declared.
_OWN_SCHEMA = ("kafka", "text")
_VALUE_SCHEMA = "value BINARY"


def encode(objects: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """All columns of a row -> one UTF-8 JSON message; columns in `keep` stay beside it instead."""
    fields = [name for name in objects.columns if name not in keep]
    return objects.select(*keep, F.to_json(F.struct(*fields)).cast("binary").alias("value"))


def publish(
    messages: DataFrame, fmt: str = "parquet", options: Mapping[str, str] | None = None
) -> None:
    """Appends the messages, with their key where they have one and the format can hold it; returns once all are written."""
    value = F.col("value").cast("string" if fmt == "text" else "binary").alias("value")
    key = ["key"] if "key" in messages.columns and fmt != "text" else []
    writer = messages.select(*key, value).write.format(fmt).mode("append")
    if fmt != "kafka":
        writer = writer.option("maxRecordsPerFile", MAX_FILE_ROWS)
    writer.options(**(options or {})).save()


def _with_folders(fmt: str, options: Mapping[str, str] | None) -> dict[str, str]:
    """The options; a directory is read with its folders, one for each published run, unless they say otherwise."""
    return ({"recursiveFileLookup": "true"} if fmt in FILE_FORMATS else {}) | dict(options or {})


def read_messages(
    spark: SparkSession, fmt: str = "parquet", options: Mapping[str, str] | None = None
) -> DataFrame:
    reader = spark.read.format(fmt).options(**_with_folders(fmt, options))
    if fmt not in _OWN_SCHEMA:
        reader = reader.schema(_VALUE_SCHEMA)
    return reader.load().select(F.col("value").cast("binary").alias("value"))


def message_stream(
    spark: SparkSession, fmt: str = "parquet", options: Mapping[str, str] | None = None
) -> DataFrame:
    """The same messages as a stream. A topic is read from its beginning unless the options say
    otherwise, so that nothing sent before the first start is lost; restarts resume from the
    checkpoint either way. The first start takes the whole backlog in one micro-batch unless the
    options bound it (maxOffsetsPerTrigger, maxFilesPerTrigger)."""
    settings = _with_folders(fmt, options)
    if fmt == "kafka":
        settings.setdefault("startingOffsets", "earliest")
    reader = spark.readStream.format(fmt).options(**settings)
    if fmt not in _OWN_SCHEMA:
        reader = reader.schema(_VALUE_SCHEMA)
    return reader.load().select(F.col("value").cast("binary").alias("value"))
