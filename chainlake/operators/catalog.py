"""Catalogs of objects and the log of their shipping."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import metrics
from .common import columns

#: Archives looked at again when a run starts.
DEFAULT_TAIL = 3


def committed_tail(
    catalog: DataFrame, n: int = DEFAULT_TAIL, key: str = "object_id"
) -> DataFrame:
    """Committed objects among the last ``n`` ids; fewer than ``n`` may remain.

    The last ids are taken first and the uncommitted (size null) dropped after.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    return catalog.orderBy(F.col(key).desc()).limit(n).filter(F.col("size").isNotNull())


def skip_existing(
    candidates: DataFrame,
    manifest: DataFrame,
    enable_duplication: bool = False,
    key: str | Sequence[str] = "object_id",
    check_failed: Column | None = None,
) -> DataFrame:
    """Candidates the store does not have yet.

    Manifest rows for which ``check_failed`` holds count as absent: an object
    whose existence could not be checked is shipped. ``enable_duplication``
    turns the check off.
    """
    if enable_duplication:
        return candidates
    key = columns(key)
    if check_failed is not None:
        manifest = manifest.filter(~F.coalesce(check_failed, F.lit(False)))
    return candidates.join(manifest.select(*key), key, "left_anti")


def shipping_summary(log: DataFrame) -> DataFrame:
    """Per object type and workchain: last shipped seqno, attempts and bytes.

    States are labelled by workchain, archives are not (null). A skipped archive
    does not move its last seqno, a skipped state does. Sizes are recorded for
    archives that were really sent, never for states.
    """
    is_archive = F.col("object_type") == "archive"
    sent = ~F.col("skipped")
    moves_gauge = sent | ~is_archive
    sent_bytes = F.when(is_archive & sent, F.col("bytes"))
    # Time and number in one value of fixed width keep the aggregate on the hash path.
    micros = F.unix_micros("finished_at").cast("decimal(18,0)")
    finished = micros * F.lit(Decimal(2**64)) + F.col("seqno")
    return (
        log.withColumn("workchain", F.when(~is_archive, F.col("workchain")))
        .groupBy("object_type", "workchain")
        .agg(
            F.max_by("seqno", F.when(moves_gauge, finished)).alias("last_seqno"),
            F.count(F.lit(1)).alias("objects"),
            F.count_if(~sent).alias("skipped"),
            F.max(F.when(sent, F.col("attempts"))).alias("max_attempts"),
            F.sum(F.when(sent, F.col("attempts") - 1)).cast("long").alias("retries"),
            F.count(sent_bytes).alias("sized_objects"),
            F.sum(sent_bytes).alias("sent_bytes"),
            F.max(sent_bytes).alias("largest_bytes"),
        )
    )


def shipping_sizes(log: DataFrame, q: str = "0.999") -> DataFrame:
    """Size quantile of the archives that were sent."""
    sent = log.filter((F.col("object_type") == "archive") & ~F.col("skipped"))
    sizes = sent.select("object_type", F.col("bytes").cast("double").alias("value"))
    return metrics.quantile(sizes, q, by="object_type")


def shipping_times(
    log: DataFrame, bounds: Sequence[float], bucket: str | int = "1 day"
) -> DataFrame:
    """Heatmap of the shipping time by object type; skipped runs count too."""
    times = log.select(
        F.col("finished_at").alias("ts"), "object_type", F.col("seconds").alias("value")
    )
    return metrics.heatmap(times, bounds, bucket, by="object_type")
