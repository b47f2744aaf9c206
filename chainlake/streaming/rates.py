"""Rates and histograms over a stream of samples, complete at every moment.

A micro-batch is logged under its number, so a repeated one replaces itself, and what
was logged is folded on reading with the batch operators. Buckets still open are there
with what has come so far; a late sample counts as soon as it comes. Nothing is kept
between batches, so there is no watermark that could drop a sample.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.times import seconds_of
from ..operators.common import columns
from ..operators.metrics import RATE_INTERVAL, SERIES, heatmap, sum_rate
from ..sinks.files import append_batch


def _follow(rows: DataFrame, fold, path: str, checkpoint: str, available_now: bool) -> StreamingQuery:
    def write(batch: DataFrame, number: int) -> None:
        append_batch(fold(batch), path, number)

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def follow_samples(
    samples: DataFrame,
    path: str,
    checkpoint: str,
    series: Sequence[str] = SERIES,
    tie: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Log what rates need of the samples: labels, time, tie-break and value."""
    names = dict.fromkeys([*columns(series), "ts", *([tie] if tie else []), "value"])
    rows = samples.filter(F.col("value").isNotNull()).select(*names)
    return _follow(rows, lambda batch: batch, path, checkpoint, available_now)


def read_rate(
    spark: SparkSession,
    path: str,
    by: str | Sequence[str] = "instance",
    bucket: str | int = RATE_INTERVAL,
    series: Sequence[str] = SERIES,
    tie: str | None = None,
) -> DataFrame:
    """``bucket, by…, rate`` of all samples logged so far."""
    return sum_rate(spark.read.parquet(path).drop("batch_id"), by, bucket, series, tie)


def follow_heatmap(
    samples: DataFrame,
    path: str,
    checkpoint: str,
    bounds: Sequence[float],
    bucket: str | int = RATE_INTERVAL,
    by: str | Sequence[str] = (),
    available_now: bool = True,
) -> StreamingQuery:
    """Log the counts of each micro-batch: a row for each cell it has samples of."""

    def cells(batch: DataFrame) -> DataFrame:
        return heatmap(batch, bounds, bucket, by).drop("rate")

    return _follow(samples, cells, path, checkpoint, available_now)


def read_heatmap(
    spark: SparkSession,
    path: str,
    bucket: str | int = RATE_INTERVAL,
    by: str | Sequence[str] = (),
) -> DataFrame:
    """``bucket, by…, le, observations, rate`` of all counts logged so far."""
    cells = spark.read.parquet(path).groupBy("bucket", *columns(by), "le")
    total = cells.agg(F.sum("observations").alias("observations"))
    return total.withColumn("rate", F.col("observations") / seconds_of(bucket))
