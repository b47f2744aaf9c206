"""Give every batch to several sinks."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..files import exists, write_whole

log = logging.getLogger(__name__)

Sink = Callable[[DataFrame, int], None]


def fan_out(
    df: DataFrame,
    sinks: Sequence[Sink] | Mapping[str, Sink],
    checkpoint: str | None = None,
    available_now: bool = True,
    progress: str | None = None,
) -> StreamingQuery | None:
    """Write a batch, or each micro-batch of a stream, to all ``sinks`` in order.

    The batch is kept (memory, then disk) so that the source is read once. What
    an executor loses is computed again from the source. A sink is called with the
    rows and the batch number.

    Without ``progress`` the first failing sink fails the batch, and all sinks are called
    again when it is repeated. With this folder, a sink that has written a batch is
    noted there by its name (or place) and number, all sinks are tried, and the batch fails
    in the end if any did; when it is repeated, only those are called.
    """
    named = dict(sinks) if isinstance(sinks, Mapping) else {str(i): sink for i, sink in enumerate(sinks)}

    def write(batch: DataFrame, number: int) -> None:
        marks = {name: f"{progress}/{name}/{number}" for name in named} if progress else {}
        left = {name: sink for name, sink in named.items() if not (marks and exists(marks[name]))}
        if not left:
            return
        kept, failed = batch.persist(StorageLevel.MEMORY_AND_DISK), []
        try:
            for name, sink in left.items():
                try:
                    sink(kept, number)
                except Exception as error:
                    if not marks:
                        raise
                    log.error("sink %s failed in batch %d: %s", name, number, error)
                    failed.append((name, error))
                else:
                    if marks:
                        write_whole(marks[name], b"")
        finally:
            kept.unpersist()
        if failed:
            names = ", ".join(name for name, _ in failed)
            raise RuntimeError(f"batch {number} is not in these sinks yet: {names}") from failed[0][1]

    if not df.isStreaming:
        write(df, 0)
        return None
    if checkpoint is None:
        raise ValueError("a stream needs a checkpoint folder")
    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
