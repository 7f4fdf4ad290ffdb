"""The incremental step driven by the stream of new flat rows instead of a timer."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from perigee.functions import day
from perigee.plans.state import StatePaths
from perigee.plans.step import process_batch
from perigee.schema import FLAT_TABLE_SCHEMA
from perigee.streaming.flat_stream import AVAILABLE_NOW


def start_step_stream(
    spark: SparkSession,
    paths: StatePaths,
    initial: date,
    trigger: Mapping[str, object] = AVAILABLE_NOW,
    options: Mapping[str, str] | None = None,
    **settings: object,
) -> StreamingQuery:
    """Runs process_batch for every micro-batch of new flat rows, with the micro-batch id as batch id.

    The checkpoint delivers each row once, so every delivered row is processed: how a backlog is cut into
    micro-batches (maxFilesPerTrigger in `options`) changes no total. Rows dated on or before `initial`
    are left out, undated ones are staged as rejects. With drop_late=True rows that the cursor has passed
    are set aside as late and counted, which does depend on the cut. A micro-batch that is retried after
    its batch was finished changes nothing; one that failed before is done anew.
    Use either this or run_available on one state directory, since both number the batches.
    """

    def step(rows: DataFrame, batch_id: int) -> None:
        wanted = F.col("approach_date").isNull() | (F.col("approach_date") > day(initial))
        process_batch(rows.where(wanted), batch_id, paths, **settings)

    flat = spark.readStream.schema(FLAT_TABLE_SCHEMA).options(**(options or {})).parquet(paths.flat)
    return (
        flat.writeStream.foreachBatch(step)
        .option("checkpointLocation", paths.checkpoint("step"))
        .trigger(**trigger)
        .start()
    )
