"""Everything that is there, then everything that arrives."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def snapshot_then_follow(
    spark: SparkSession,
    path: str,
    schema: StructType,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    follow: bool = False,
    interval: str = "1 second",
    max_files_per_trigger: int = 1000,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Pass the objects under ``path`` through ``handle``, old ones first.

    Backlog and later arrivals take the same way. Without ``follow`` the query
    ends once the backlog is done; a later call with the same ``checkpoint``
    goes on from there. An error in ``handle`` ends the query. ``handle`` gets
    the batch and its number and should write idempotently by that number, as a
    batch may be repeated after a failure.
    """
    rows = (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(path)
    )
    writer = rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if follow else {"availableNow": True}
    return writer.trigger(**trigger).start()
