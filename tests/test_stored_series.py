"""Sketches that merge, the index of series, and values aligned in time."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chainlake import metrics
from chainlake.operators import series, sketches


def samples(spark, rows):
    schema = "at double, metric string, instance long, job long, kind long, value double"
    return spark.createDataFrame(rows, schema).select(F.timestamp_micros((F.col("at") * 1_000_000).cast("long")).alias("ts"), "metric", "instance", "job", "kind", "value")


@pytest.mark.parametrize("order", [1, 2, 3])
def test_sketches_merge_in_any_order(spark, order):
    """A third of the values in one series; many equal values; every way of merging."""
    df = spark.range(120_000).select(
        F.timestamp_seconds(F.col("id") % 5000).alias("ts"),
        F.lit("m").alias("metric"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 11).alias("instance"),
        (F.col("id") % 2).alias("job"),
        F.when(F.col("id") % 5 == 0, 7.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(100_000)).cast("double")).alias("value"),
    )
    stored = sketches.sketch(df.repartition(order * 3), 100)
    assert stored.count() > 500 and stored.agg(F.sum("samples")).first()[0] == 120_000
    if order == 2:
        stored = sketches.merge(stored, ["bucket", "job"])
    if order == 3:
        stored = sketches.merge(sketches.merge(stored, ["instance", "job", "metric"]), ["job", "metric"])
    values = np.sort([r.value for r in df.select("value").collect()])
    for q in ("0", "0.5", "0.95", "1"):
        found = sketches.quantile(stored, q, []).first().value
        low, high = np.searchsorted(values, found, "left"), np.searchsorted(values, found, "right")
        error = 3 * sketches.rank_error() * len(values) + 1
        assert low - error <= float(q) * len(values) <= high + error
    with pytest.raises(ValueError, match="quantile must be one of"):
        sketches.quantile(stored, "0.42")


@pytest.fixture
def indexed(spark, folder):
    rng, path = np.random.default_rng(2), folder("series")
    rows = [(float(t), str(rng.choice(["a", "b"])), int(rng.integers(0, 30)) or None, int(rng.integers(0, 2)), int(rng.integers(0, 5)), 1.0) for t in rng.integers(0, 10 * 86_400, 4000)]
    df = samples(spark, rows)
    for batch in range(2):
        for _ in range(batch + 1):  # the second batch comes twice
            series.add_samples(df.where(F.pmod(F.xxhash64("ts"), F.lit(2)) == batch), path, batch)
    return df, path


def test_selection_by_the_index_is_that_of_the_scan(spark, indexed, rows):
    df, path = indexed
    for matchers in ({}, {"instance": 7}, {"instance": [3, 4, 5], "job": 1}, {"kind": metrics.Matching("[12]")}):
        got = series.select_indexed(spark, path, "a", matchers)
        assert rows(got, *df.columns) == rows(metrics.select_series(df, "a", matchers))
    day = [F.timestamp_seconds(F.lit(86_400 * n)) for n in (3, 4)]
    since, until = (spark.range(1).select(d).first()[0] for d in day)
    got = series.select_indexed(spark, path, ["a", "b"], {"job": 0}, since, until)
    want = metrics.select_series(df, ["a", "b"], {"job": 0}).where((F.col("ts") >= F.lit(since)) & (F.col("ts") < F.lit(until)))
    assert rows(got, *df.columns) == rows(want) and got.count() > 50
    assert rows(series.indexed_label_values(spark, path, "a", "kind")) == rows(metrics.label_values(df, "a", "kind"))


def scanned(df):
    """Rows that the scans of samples put out when the query ran."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            todo.append(node.executedPlan())
            continue
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if node.nodeName().startswith("Scan parquet") and "value" in node.schema().simpleString():
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return sum(found)


def test_the_index_prunes_what_is_scanned(spark, indexed):
    df, path = indexed
    every = scanned(spark.read.parquet(f"{path}/samples"))
    assert every == 4000
    one = scanned(series.select_indexed(spark, path, "a", {"instance": 7, "job": 1}))
    some = scanned(series.select_indexed(spark, path, "a", {"instance": [3, 4, 5, 6, 7, 8, 9, 10]}))
    assert one < some < every and one < every / 5
    assert scanned(series.indexed_label_values(spark, path, "a", "kind")) == 0


def aligned(rows, seconds, lookback):
    """``a - b`` by brute force: the last value of either side in each bucket that has one."""
    last = {}
    for at, metric, instance, job, _, value in sorted(rows, key=lambda r: r[0]):
        if value is not None and instance is not None and job is not None:
            last[metric, instance, job, int(at // seconds) * seconds] = value
    out = []
    for bucket, instance, job in {(b, i, j) for _, i, j, b in last}:
        found = []
        for metric in "ab":
            ages = [last[metric, instance, job, b] for b in range(bucket, bucket - lookback * seconds - 1, -seconds) if (metric, instance, job, b) in last]
            found += ages[:1]
        if len(found) == 2:
            out.append((bucket, instance, job, found[0] - found[1]))
    return sorted(out)


@pytest.mark.parametrize("lookback, page", [(1, 4), (3, 4), (50, 8), (1000, 1024), (1000, 1)])
def test_values_are_aligned_in_time(spark, rows, monkeypatch, lookback, page):
    monkeypatch.setattr(metrics, "ALIGNED", page)
    rng = np.random.default_rng(lookback)
    given = [
        (float(t), str(rng.choice(["a", "b"])), int(rng.integers(0, 3)) or None, 1, 0, None if rng.random() < 0.1 else float(rng.integers(0, 99)))
        for t in rng.permutation(60_000)[:300]
    ]
    df = samples(spark, given)
    sides = [df.filter(F.col("metric") == m) for m in "ab"]
    got = metrics.binary_op(*sides, "-", bucket=10, lookback=lookback, series=["instance", "job"])
    assert rows(got, "bucket", "instance", "job", "value") == aligned(given, 10, lookback)
    assert got.count() <= 300
