"""The flows of the toolkit, put together from its operators."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, fields
from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import seconds_of
from ..operators import blocks as block_ops
from ..operators import catalog as catalog_ops
from ..operators import integrity, objects
from ..operators.common import columns
from ..operators.state import account_changes, latest_state
from ..sinks.files import archives, snapshots
from ..sources.archives import read_archives

log = logging.getLogger(__name__)


def publish(blocks: DataFrame, pack: bool = True) -> DataFrame:
    """Blocks to sink records: flatten, check, key, route, pack.

    Narrow from the scan to the sink. An unreadable item fails its whole block.
    """
    transactions = block_ops.flatten_transactions(blocks, validate=True)
    if not pack:
        return block_ops.to_sink_record(transactions)
    return block_ops.to_sink_record(block_ops.pack_payload(transactions), "packed")


def expected_etags(
    chunks: DataFrame, part_size: int, key: str | Sequence[str] = "object_id"
) -> DataFrame:
    """Composite tag, part count and size of each object in a chunk table."""
    parts = objects.rechunk(chunks, part_size, key)
    return integrity.composite_etag(integrity.part_md5(parts, key), key)


@dataclass(frozen=True)
class ShipConfig:
    """Settings of shipping; unknown names are rejected.

    ``max_concurrency`` is accepted and has no effect: the cluster's task slots
    are the bound. ``max_attempts`` is ours; None repeats without limit.
    """

    # Names and defaults of the settings files that users have.
    retry_delay: str | int = "1 second"
    max_concurrency: int | None = None
    enable_duplication: bool = False
    last_archives_to_upload: int = catalog_ops.DEFAULT_TAIL
    max_attempts: int | None = None

    @classmethod
    def of(cls, settings: ShipConfig | Mapping[str, object] | None) -> ShipConfig:
        if isinstance(settings, cls):
            return settings
        settings = settings or {}
        unknown = sorted(set(settings) - {field.name for field in fields(cls)})
        if unknown:
            raise ValueError(f"unknown shipping settings: {unknown}")
        config = cls(**settings)
        seconds_of(config.retry_delay)
        return config


def store(table: DataFrame, path: str) -> None:
    """Store a table; replaces what an earlier run left under the same path."""
    table.write.mode("overwrite").parquet(path)


def ship(
    spark: SparkSession,
    catalog: DataFrame,
    chunks: DataFrame,
    manifest: DataFrame,
    path: str,
    part_size: int,
    config: ShipConfig | Mapping[str, object] | None = None,
    key: str | Sequence[str] = "object_id",
    on_error: str = "continue",
    put: Callable[[DataFrame, str], None] = store,
) -> DataFrame:
    """Ship the objects the store lacks as fixed-size parts until they verify.

    Each attempt cuts the pending objects into parts from their first byte on,
    stores them with their digests in a folder of its own, reads the folder back
    and compares tag and size. What does not match goes into the next attempt.
    Objects of unknown size are never tried: ``continue`` leaves them out,
    ``stop`` raises. Returns ``key, etag, parts, size, attempt, reason``. Attempts go
    on without limit unless one is set; then the objects that remain are returned,
    too, with the ``reason`` ``unverified``, their expected size and no tag, and
    ``stop`` raises instead. The driver only learns whether some remain.
    """
    key, config = columns(key), ShipConfig.of(config)
    missing = catalog_ops.skip_existing(catalog, manifest, config.enable_duplication, key)
    if on_error == "stop" and not integrity.unsized(missing).isEmpty():
        raise RuntimeError("objects of unknown size cannot be shipped")
    left = missing.filter(F.col("size").isNotNull()).select(
        *key, F.col("size").alias("_size")
    )
    for attempt in count(1):
        # A written list of known size, so that it is found out only once. One
        # folder per attempt: Spark takes two readings of the same folder in a
        # plan for the same data, even where files came in between.
        store(left, f"{path}/todo/{attempt}")
        todo = spark.read.parquet(f"{path}/todo/{attempt}")
        wanted = chunks.join(todo, key, "left_semi")
        parts = objects.rechunk(wanted, part_size, key).withColumns(
            {"length": F.octet_length("data").cast("long"), "md5": F.md5("data")}
        )
        put(parts, f"{path}/parts/{attempt}")
        stored = spark.read.schema(parts.schema).parquet(f"{path}/parts/{attempt}")
        promised = integrity.composite_etag(stored.drop("data"), key, todo, strict=False)
        digests = integrity.part_md5(stored, key)
        reported = integrity.composite_etag(digests, key, todo, strict=False)
        checked = integrity.verify(promised, integrity.manifest_of(reported, key), key)
        verified = checked.join(todo, key).filter(
            F.col("verified") & (F.col("size") == F.col("_size"))
        )
        # The first attempt clears what an earlier run left; the folder is read as one
        # table in the end, so the plan is the same for any number of attempts.
        kept = verified.select(*key, "etag", "parts", "size", F.lit(attempt).alias("attempt"))
        kept.write.mode("overwrite" if attempt == 1 else "append").partitionBy("attempt").parquet(f"{path}/verified")
        done = spark.read.schema(kept.schema).parquet(f"{path}/verified")
        left = todo.join(done.filter(F.col("attempt") == attempt), key, "left_anti")
        done = done.withColumn("reason", F.lit(None).cast("string"))
        if left.isEmpty():
            return done
        if attempt == config.max_attempts:
            if on_error == "stop":
                raise RuntimeError(f"objects left unverified after {attempt} attempts")
            rest = {
                "etag": F.lit(None).cast("string"),
                "parts": F.lit(None).cast("long"),
                "size": F.col("_size"),
                "attempt": F.lit(attempt),
                "reason": F.lit("unverified"),
            }
            return done.unionByName(left.withColumns(rest).drop("_size"))
        log.warning("attempt %d left objects to ship again", attempt)
        time.sleep(seconds_of(config.retry_delay))


def ship_committed_tail(
    spark: SparkSession,
    catalog: DataFrame,
    chunks: DataFrame,
    manifest: DataFrame,
    path: str,
    part_size: int,
    config: ShipConfig | Mapping[str, object] | None = None,
    key: str = "object_id",
) -> DataFrame:
    """Catch-up at the start of a run: ship the last committed archives."""
    config = ShipConfig.of(config)
    tail = catalog_ops.committed_tail(catalog, config.last_archives_to_upload, key)
    return ship(spark, tail, chunks, manifest, path, part_size, config, key)


def replay(
    spark: SparkSession,
    archive_path: str,
    snapshot_path: str | None = None,
    snapshot_key: Mapping[str, object] | None = None,
    ids: Sequence[int] | DataFrame | None = None,
    order: Sequence[str] = ("seqno", "lt"),
) -> DataFrame:
    """Archives to the latest state per account, optionally kept as a snapshot."""
    blocks = read_archives(spark, archive_path, ids)
    changes = account_changes(block_ops.flatten_transactions(blocks))
    latest = latest_state(changes, "account", order)
    if snapshot_path:
        snapshots([(snapshot_key, latest)], snapshot_path)
    return latest


def store_blocks(blocks: DataFrame, path: str, blocks_per_archive: int, placed: bool = False) -> None:
    """Bundle blocks into archives and write the closed and open ones alike.

    ``placed`` says that the blocks of an archive are in one task, or in as few as they need.
    """
    archives(block_ops.bundle(blocks, blocks_per_archive).drop("closed"), path, placed=placed)
