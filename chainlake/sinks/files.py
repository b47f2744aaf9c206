"""Archive and snapshot folders on a shared file system or object store."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from ..operators.common import columns

log = logging.getLogger(__name__)

#: Rows per file, so that a large archive becomes several files.
MAX_RECORDS_PER_FILE = 5_000_000

# Folder levels of a snapshot and what to do after a failure.
SNAPSHOT_KEY = ("workchain", "seqno", "kind")
ON_ERROR = ("stop", "continue")


def _replacing(df: DataFrame, key: Sequence[str], max_records: int) -> DataFrameWriter:
    """Writer that replaces the partitions present in ``df`` and no others."""
    return (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records)
        .partitionBy(*key)
    )


def archives(
    df: DataFrame,
    path: str,
    key: str | Sequence[str] = "archive_id",
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
    placed: bool = False,
) -> None:
    """Write archives, one folder per key; existing ones of the same key are replaced.

    The rebalance hint brings an archive's rows together for few, large files
    and lets adaptive execution split an archive that is too large for a task. Rows
    that already are where they belong (``placed``) go without another shuffle.
    """
    key = columns(key)
    rows = df if placed else df.hint("rebalance", *key)
    _replacing(rows, key, max_records_per_file).parquet(path)


def append_batch(df: DataFrame, path: str, number: int, column: str = "batch_id") -> None:
    """Write a micro-batch under its own number; a repeated batch replaces itself."""
    numbered = df.withColumn(column, F.lit(number).cast("long"))
    _replacing(numbered, [column], MAX_RECORDS_PER_FILE).parquet(path)


def snapshots(
    frames: DataFrame | Iterable[tuple[Mapping[str, object], DataFrame]],
    path: str,
    on_error: str = "stop",
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
) -> list[tuple[dict, str | None]]:
    """Write each ``(key, state)`` under ``workchain / seqno / kind``.

    Returns each key with its error, or None. ``stop`` raises at the first
    snapshot that fails, so later ones are not tried; ``continue`` logs it and
    goes on with the next. One table that holds the key columns is written by one
    job, which keeps all of its snapshots or none.
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {', '.join(ON_ERROR)}")
    if isinstance(frames, DataFrame):
        table = frames.hint("rebalance", *SNAPSHOT_KEY)
        _replacing(table, SNAPSHOT_KEY, max_records_per_file).parquet(path)
        return []
    results: list[tuple[dict, str | None]] = []
    for key, state in frames:
        missing = [name for name in SNAPSHOT_KEY if name not in key]
        if missing:
            raise ValueError(f"snapshot key lacks {missing}")
        labelled = state.withColumns({name: F.lit(key[name]) for name in SNAPSHOT_KEY})
        try:
            _replacing(labelled, SNAPSHOT_KEY, max_records_per_file).parquet(path)
        except Exception as error:
            if on_error == "stop":
                raise
            log.error("snapshot %s failed: %s", dict(key), error)
            results.append((dict(key), str(error)))
        else:
            results.append((dict(key), None))
    return results
