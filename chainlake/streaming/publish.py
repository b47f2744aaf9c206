"""Publish the transactions of a block stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.flows import publish
from ..sinks.fanout import fan_out


def publish_stream(
    blocks: DataFrame,
    sinks: Sequence[Callable[[DataFrame, int], None]],
    checkpoint: str,
    pack: bool = True,
    available_now: bool = True,
) -> StreamingQuery:
    """Flatten, key, route and pack blocks as they arrive; write to all ``sinks``.

    The checkpoint moves on only after every sink took the batch: at least once.
    """
    return fan_out(publish(blocks, pack), sinks, checkpoint, available_now)
