"""Rates of a stream kept in state: nothing that came before is read again.

Each series keeps the samples of its open buckets and the last one before them. A batch
brings its samples in where they belong in time, whatever the order they come in, and emits
by how much the increase of a bucket has changed: also that of the next bucket, whose first
step may now begin elsewhere. Changes are logged; their sum is what the batch operators
give for all samples. Buckets older than ``keep`` are closed and leave one sample behind, so
state is bounded by series and open buckets. Samples that come after their bucket was closed
can't be placed any more; they are counted in ``late``.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.times import seconds_of
from ..operators.common import columns
from ..operators.metrics import RATE_INTERVAL, SERIES
from ..session import rocksdb_state
from ..sinks.files import append_batch

SAMPLE = np.dtype([("ts", "<i8"), ("tie", "<i8"), ("value", "<f8")])
NOTHING = np.zeros(0, SAMPLE)


def steps(before: np.ndarray, own: np.ndarray) -> tuple[float, int]:
    """Increase over the samples ``own`` and how many of them have one before."""
    values = np.concatenate([before, own])["value"]
    gains = np.where(values[1:] < values[:-1], values[1:], values[1:] - values[:-1])
    return float(gains.sum()), len(gains)


class SeriesSteps(StatefulProcessor):
    """Changes of each bucket's increase, from the samples of one series."""

    def __init__(self, names: list[str], seconds: int, keep: int | None):
        self.names, self.micros, self.seconds, self.keep = names, seconds * 1_000_000, seconds, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getMapState("open", "bucket long", "samples binary")
        self.closed = handle.getValueState("closed", "until long, samples binary")

    def close(self) -> None:
        pass

    def load(self, bucket: int) -> np.ndarray:
        return np.frombuffer(bytes(self.open.getValue((bucket,))[0]), SAMPLE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new = np.array([(r["ts__"], r["tie__"], r["value__"]) for r in rows], SAMPLE)
        until, last = self.closed.get() if self.closed.exists() else (None, b"")
        bucket = new["ts"] // self.micros
        placed = np.ones(len(new), bool) if until is None else bucket >= until
        late = Counter(bucket[~placed].tolist())
        changed = {b: (0.0, 0, n) for b, n in late.items()}
        changed |= self.bring_in(new[placed], bucket[placed], np.frombuffer(bytes(last), SAMPLE))
        for b, change in sorted(changed.items()):
            if any(change):
                yield Row(**dict(zip(self.names, (b * self.seconds, *key, *change))))

    def bring_in(self, new: np.ndarray, bucket: np.ndarray, base: np.ndarray) -> dict[int, tuple[float, int, int]]:
        known = sorted(k[0] for k in self.open.keys())
        touched = np.unique(bucket).tolist()
        every = sorted({*known, *touched})
        was, now = {}, {}

        def stored(b: int) -> np.ndarray:
            if b not in was:
                was[b] = self.load(b) if b in has else NOTHING
            return was[b]

        has = set(known)
        for b in touched:
            merged = np.concatenate([stored(b), new[bucket == b]])
            now[b] = merged[np.lexsort((merged["tie"], merged["ts"]))]
        changed = {}
        affected = sorted({*touched, *(every[i + 1] for b in touched if (i := every.index(b)) + 1 < len(every))})
        for b in affected:
            at = bisect_left(known, b)
            before_was = stored(known[at - 1])[-1:] if at else base
            at = bisect_left(every, b)
            before_now = (now.get(every[at - 1], None) if every[at - 1] in now else stored(every[at - 1]))[-1:] if at else base
            old, own = stored(b), now.get(b, stored(b))
            gain_was, steps_was = steps(before_was, old) if len(old) else (0.0, 0)
            gain_now, steps_now = steps(before_now, own)
            changed[b] = (gain_now - gain_was, steps_now - steps_was, 0)
        for b, samples in now.items():
            self.open.updateValue((b,), (samples.tobytes(),))
        if self.keep is not None and every:
            self.close_before(every[-1] - self.keep, every, now)
        return changed

    def close_before(self, until: int, every: list[int], now: dict[int, np.ndarray]) -> None:
        """Leave one sample of the buckets before ``until``."""
        old = [b for b in every if b < until]
        if old:
            last = now[old[-1]] if old[-1] in now else self.load(old[-1])
            self.closed.update((until, last[-1:].tobytes()))
            for b in old:
                self.open.removeKey((b,))


def follow_rates(
    samples: DataFrame,
    path: str,
    checkpoint: str,
    bucket: str | int = RATE_INTERVAL,
    series: Sequence[str] = SERIES,
    tie: str | None = None,
    keep: str | int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Log the changes of every bucket's increase under ``path``.

    ``keep`` is how long a bucket stays open after the newest one of its series; unset,
    all stay open and samples may come in any order for ever. A repeated batch replaces
    itself. ``tie`` must be a whole number.
    """
    labels, seconds = columns(series), seconds_of(bucket)
    rows = samples.filter(F.col("value").isNotNull()).select(
        *labels,
        F.unix_micros("ts").alias("ts__"),
        (F.col(tie).cast("long") if tie else F.lit(0).cast("long")).alias("tie__"),
        F.col("value").cast("double").alias("value__"),
    )
    fields = [T.StructField("bucket", T.LongType()), *(rows.schema[n] for n in labels)]
    out = T.StructType([*fields, T.StructField("gain", T.DoubleType()), T.StructField("steps", T.LongType()), T.StructField("late", T.LongType())])
    open_buckets = None if keep is None else -(-seconds_of(keep) // seconds)
    changes = rows.groupBy(*labels).transformWithState(SeriesSteps(out.names, seconds, open_buckets), out, "update", "none")
    writer = changes.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(lambda batch, number: append_batch(batch, path, number))
    with rocksdb_state(samples.sparkSession):
        return (writer.trigger(availableNow=True) if available_now else writer).start()


def _grown(spark: SparkSession, path: str, by: Sequence[str]) -> DataFrame:
    log = spark.read.parquet(path).groupBy("bucket", *by)
    return log.agg(F.sum("gain").alias("increase"), F.sum("steps").alias("_steps")).filter(F.col("_steps") > 0).drop("_steps")


def read_rates(spark: SparkSession, path: str, by: str | Sequence[str] = "instance", bucket: str | int = RATE_INTERVAL) -> DataFrame:
    """``bucket, by…, rate`` of all samples that were placed."""
    rate = F.col("increase") / seconds_of(bucket)
    return _grown(spark, path, columns(by)).withColumn("rate", rate).drop("increase")


def read_percent(
    spark: SparkSession, path: str, numerator: str, denominator: str, by: str | Sequence[str] = "instance"
) -> DataFrame:
    """``bucket, by…, percent``: rate of one counter in percent of another.

    A bucket with one of them alone drops out; division by a zero rate gives null.
    """
    by = columns(by)
    grown = _grown(spark, path, ["metric", *(n for n in by if n != "metric")])
    side = lambda m: F.sum(F.when(F.col("metric") == m, F.col("increase")))
    sides = grown.groupBy("bucket", *by).agg(side(numerator).alias("_a"), side(denominator).alias("_b"))
    both = sides.filter(F.col("_a").isNotNull() & F.col("_b").isNotNull())
    return both.select("bucket", *by, (F.try_divide("_a", "_b") * 100).alias("percent"))


def read_hit_rate(spark: SparkSession, path: str, miss: str, total: str, by: str | Sequence[str] = ()) -> DataFrame:
    """``bucket, by…, hit_rate``: percent of calls that were no miss."""
    found = read_percent(spark, path, miss, total, by)
    return found.withColumn("hit_rate", 100 - F.col("percent")).drop("percent")


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """``bucket, samples``: how many came after their bucket was closed."""
    return spark.read.parquet(path).groupBy("bucket").agg(F.sum("late").alias("samples")).filter(F.col("samples") > 0)
