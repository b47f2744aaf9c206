"""An index of series: which labels a series has, on which days, and where its samples lie.

Samples are stored by day and by a bucket of their series. The index has one row for each
series and day, however many samples that is, so matchers and label values look at the
index alone, and the samples of the days and buckets found are all that is then read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import columns
from .metrics import SERIES, select_series

#: Buckets that the series of a day are dealt over.
BUCKETS = 64
PLACE = ("day", "series_bucket")


def series_bucket(labels: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*labels), F.lit(buckets)).cast("int")


def placed(samples: DataFrame, series: Sequence[str] = SERIES, buckets: int = BUCKETS) -> DataFrame:
    """Samples with the ``day`` and ``series_bucket`` they are stored under."""
    return samples.withColumns({"day": F.to_date("ts"), "series_bucket": series_bucket(columns(series), buckets)})


def series_of(stored: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Index rows of placed samples: labels, place, samples, first and last time."""
    found = stored.groupBy(*PLACE, *labels)
    return found.agg(F.count(F.lit(1)).alias("samples"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def add_samples(
    samples: DataFrame,
    path: str,
    batch: int,
    labels: Sequence[str] = (*SERIES, "kind"),
    series: Sequence[str] = SERIES,
    buckets: int = BUCKETS,
) -> None:
    """Store a batch of samples and its index rows; a repeated batch replaces itself.

    The index is made from what was stored, and grows by one row for each series and day of
    the batch. A day's bucket of samples may be split over several files.
    """
    spread = placed(samples, series, buckets).withColumn("batch_id", F.lit(batch).cast("long"))
    keys = ["batch_id", *PLACE]
    writer = spread.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).parquet(f"{path}/samples")
    stored = samples.sparkSession.read.schema(spread.schema).parquet(f"{path}/samples").filter(F.col("batch_id") == batch)
    index = series_of(stored, columns(labels)).withColumn("batch_id", F.lit(batch).cast("long"))
    writer = index.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("batch_id").parquet(f"{path}/index")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """All index rows; a series has one for each batch that brought samples of a day."""
    return spark.read.parquet(f"{path}/index")


def find_series(
    spark: SparkSession, path: str, metric: str | Sequence[str], matchers: Mapping | None = None, since=None, until=None
) -> DataFrame:
    """Index rows of the series that match and have samples from ``since`` until before ``until``."""
    found = select_series(read_index(spark, path), metric, matchers)
    if since is not None:
        found = found.filter(F.col("last_ts") >= F.lit(since))
    return found if until is None else found.filter(F.col("first_ts") < F.lit(until))


def select_indexed(
    spark: SparkSession, path: str, metric: str | Sequence[str], matchers: Mapping | None = None, since=None, until=None
) -> DataFrame:
    """The samples of :func:`~chainlake.operators.metrics.select_series`, read by the index.

    The places of the series found prune the scan while the query runs. Where they are
    too many to be sent to all tasks, Spark joins them instead; the matchers are then
    applied to the samples themselves as well, so the result is the same.
    """
    places = find_series(spark, path, metric, matchers, since, until).select("batch_id", *PLACE).distinct()
    samples = spark.read.parquet(f"{path}/samples").join(places, ["batch_id", *PLACE], "left_semi")
    chosen = select_series(samples, metric, matchers)
    if since is not None:
        chosen = chosen.filter(F.col("ts") >= F.lit(since))
    chosen = chosen if until is None else chosen.filter(F.col("ts") < F.lit(until))
    return chosen.drop("batch_id", *PLACE)


def indexed_label_values(spark: SparkSession, path: str, metric: str, label: str, since=None, until=None) -> DataFrame:
    """Distinct values of a label of a metric; no sample is read."""
    found = find_series(spark, path, metric, None, since, until)
    return found.select(label).filter(F.col(label).isNotNull()).distinct()
