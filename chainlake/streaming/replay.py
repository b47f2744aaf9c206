"""Replay of archives as they come."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.blocks import flatten_transactions
from ..operators.state import account_changes
from ..session import listing_session
from ..sources.archives import read_archives
from .state import follow_state, read_state


def follow_archives(
    spark: SparkSession,
    archive_path: str,
    path: str,
    checkpoint: str,
    order: Sequence[str] = ("seqno", "lt"),
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Replay archives as they come: only new ones are read, state is kept in a log.

    Takes what is there and returns the latest state per account so far.
    """
    blocks = read_archives(listing_session(spark), archive_path, stream=True, max_files_per_trigger=max_files_per_trigger)
    changes = account_changes(flatten_transactions(blocks))
    follow_state(changes, path, checkpoint, "account", order).awaitTermination()
    return read_state(spark, path, "account", order)
