"""Quantiles from stored sketches that merge over any time and any labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import bucket_start
from .common import columns
from .metrics import RATE_INTERVAL, SERIES, check_quantile

#: Size parameter of a sketch: some 2 * K values, whatever it has seen.
K = 800


def rank_error(k: int = K) -> float:
    """Share of the ranks by which a quantile is off at most, in 99 of 100 cases.

    The published fit for this kind of sketch; merging in any order doesn't change it.
    """
    return 2.296 / k**0.9021


def sketch(df: DataFrame, bucket: str | int = RATE_INTERVAL, series: Sequence[str] = SERIES, k: int = K) -> DataFrame:
    """``bucket, series…, samples, sketch``: what is stored in place of the samples.

    Every task sketches its own samples of a bucket before anything is shuffled, so a busy
    series costs no more than its sketches.
    """
    found = df.filter(F.col("value").isNotNull()).withColumn("bucket", bucket_start("ts", bucket))
    value = F.col("value").cast("double")
    return found.groupBy("bucket", *columns(series)).agg(
        F.count(F.lit(1)).alias("samples"), F.kll_sketch_agg_double(value, k).alias("sketch")
    )


def merge(sketches: DataFrame, by: str | Sequence[str] = (), k: int = K) -> DataFrame:
    """``by…, samples, sketch``: sketches of coarser groups, to be stored again or asked."""
    return sketches.groupBy(*columns(by)).agg(F.sum("samples").alias("samples"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def quantile(sketches: DataFrame, q: str, by: str | Sequence[str] = "instance", k: int = K) -> DataFrame:
    """``by…, value``: the quantile over all sketches of a group.

    ``q`` is one of those that :func:`~chainlake.operators.metrics.quantile` accepts. The rank of
    the value is within :func:`rank_error` of the share asked for.
    """
    share = float(check_quantile(q))
    merged = merge(sketches, by, k)
    return merged.select(*columns(by), F.kll_sketch_get_quantile_double("sketch", F.lit(share)).alias("value"))
