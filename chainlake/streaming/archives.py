"""Archives of a stream of blocks, each emitted once, when it closes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sinks.files import append_batch


def closing_archives(blocks: DataFrame, blocks_per_archive: int, size: Column | str | None = None, lateness: int = 0) -> DataFrame:
    """``archive_id, blocks, first_seqno, last_seqno, size`` of archives as they close.

    Archives are those of :func:`~chainlake.operators.blocks.bundle`: an archive closes once a
    block of a later one has come, or, with ``lateness``, one of an archive that many
    further on. The number of a block serves as its time, so that the watermark is the
    newest block and Spark keeps one row of state for each open archive, emits it once and
    then drops it. A block that comes after its archive closed is dropped, and counted by
    Spark in ``numRowsDroppedByWatermark``.
    """
    if blocks_per_archive < 1 or lateness < 0:
        raise ValueError("blocks_per_archive must be positive, lateness not negative")
    size = F.col(size) if isinstance(size, str) else F.lit(None).cast("long") if size is None else size
    rows = blocks.select("seqno", size.alias("_size"), F.timestamp_seconds("seqno").alias("_at"))
    late = rows.withWatermark("_at", f"{lateness * blocks_per_archive} seconds")
    found = late.groupBy(F.window("_at", f"{blocks_per_archive} seconds").alias("_span")).agg(
        F.count(F.lit(1)).alias("blocks"),
        F.min("seqno").alias("first_seqno"),
        F.max("seqno").alias("last_seqno"),
        F.sum("_size").alias("size"),
    )
    return found.select(F.unix_seconds("_span.start").alias("archive_id"), "blocks", "first_seqno", "last_seqno", "size")


def follow_closed_archives(
    blocks: DataFrame,
    path: str,
    checkpoint: str,
    blocks_per_archive: int,
    size: Column | str | None = None,
    lateness: int = 0,
    available_now: bool = True,
) -> StreamingQuery:
    """Append each archive that closes to ``path``; across restarts it is there once."""
    closing = closing_archives(blocks, blocks_per_archive, size, lateness)
    writer = closing.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(lambda batch, number: append_batch(batch, path, number))
    return (writer.trigger(availableNow=True) if available_now else writer).start()
