"""Message stream -> flat table: stateless, exactly once by checkpoint and file-sink log."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from perigee.operators.flatten import flatten
from perigee.schema import MAX_FILE_ROWS
from perigee.sources.messages import message_stream
from perigee.sources.tables import by_month

# Trigger settings: a live feed every 30 seconds, or everything that is there and stop.
LIVE = {"processingTime": "30 seconds"}
AVAILABLE_NOW = {"availableNow": True}


def write_flat_stream(
    flat: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] = LIVE,
    name: str | None = None,
) -> StreamingQuery:
    """Starts appending a streaming flat DataFrame to the flat table at `path`."""
    writer = (
        by_month(flat)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("maxRecordsPerFile", MAX_FILE_ROWS)
        .option("checkpointLocation", checkpoint)
        .partitionBy("approach_month")
        .trigger(**trigger)
    )
    if name is not None:
        writer = writer.queryName(name)
    return writer.start()


def run_flat_stream(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    trigger: Mapping[str, object] = AVAILABLE_NOW,
    timeout: float | None = None,
) -> StreamingQuery:
    """Source, flatten and sink in one; waits until the query ends or the timeout (seconds) passes."""
    query = write_flat_stream(
        flatten(message_stream(spark, fmt, options)), path, checkpoint, trigger
    )
    query.awaitTermination(*(() if timeout is None else (timeout,)))
    return query
