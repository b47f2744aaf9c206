import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chainlake import metrics
from chainlake.operators.metrics import Matching

SCHEMA = "ts timestamp, metric string, instance long, job long, kind long, value double"


def samples(spark, data, schema=SCHEMA):
    """Rows with ``ts`` in seconds."""
    return spark.createDataFrame(data, schema.replace("ts timestamp", "s double")).select(
        F.timestamp_micros((F.col("s") * 1000000).cast("long")).alias("ts"), "*"
    ).drop("s")


@pytest.fixture
def counters(spark):
    return samples(
        spark,
        [
            (0.0, "hit", 1, 0, 1, 10.0),
            (1.0, "hit", 1, 0, 1, 15.0),
            (2.0, "hit", 1, 0, 1, 3.0),
            (3.0, "hit", 1, 0, 1, 4.0),
            (12.0, "hit", 1, 0, 1, 100.0),
            (1.0, "hit", 2, 0, 1, 5.0),
            (4.0, "hit", 2, 0, 1, None),
            (9.0, "hit", 2, 0, 1, 7.0),
            (0.0, "all", 1, 0, 1, 0.0),
            (9.0, "all", 1, 0, 1, 18.0),
        ],
    )


# --- Selection --------------------------------------------------------------


def test_select_by_metric_and_labels(spark, rows):
    df = samples(
        spark,
        [
            (0.0, "a", 1, 0, 10, 1.0),
            (0.0, "a", 2, 1, 110, 2.0),
            (0.0, "a", 3, 1, None, 3.0),
            (0.0, "b", 4, 0, 10, 4.0),
        ],
    )

    def chosen(metric, matchers=None):
        return [v for (v,) in rows(metrics.select_series(df, metric, matchers), "value")]

    assert chosen("a") == [1.0, 2.0, 3.0]
    assert chosen(["a", "b"], {"job": 0}) == [1.0, 4.0]
    assert chosen("a", {"instance": [1, 3]}) == [1.0, 3.0]
    # Patterns are anchored; ".*" also matches series without the label.
    assert chosen("a", {"kind": Matching("10")}) == [1.0]
    assert chosen("a", {"kind": Matching("1|.*10")}) == [1.0, 2.0]
    assert chosen("a", {"kind": Matching(".*")}) == [1.0, 2.0, 3.0]
    assert chosen("a", {"kind": Matching(".+")}) == [1.0, 2.0]


def test_select_from_a_label_map(spark, rows):
    df = spark.createDataFrame(
        [("a", {"zone": "x"}, 1.0), ("a", {}, 2.0)], "metric string, labels map<string,string>, value double"
    )
    assert rows(metrics.select_series(df, "a", {"zone": "x"}), "value") == [(1.0,)]
    assert rows(metrics.label_values(df, "a", "zone")) == [("x",)]
    assert rows(metrics.promote_labels(df, "zone"), "value", "zone") == [(1.0, "x"), (2.0, None)]


@pytest.mark.parametrize("metric", [1, None, ["a", 2], {"a"}])
def test_select_rejects_other_types(counters, metric):
    with pytest.raises(TypeError):
        metrics.select_series(counters, metric)


def test_select_rejects_bad_matchers(counters):
    with pytest.raises(TypeError):
        metrics.select_series(counters, "hit", {"job": {0}})
    with pytest.raises(ValueError):
        metrics.select_series(counters, "hit", {"nothing": "x"})


def test_selection_reaches_the_scan(spark, counters, folder):
    path = folder("samples")
    counters.write.parquet(path)
    chosen = metrics.select_series(spark.read.parquet(path), "hit", {"job": [0, 1]})
    plan = chosen.select("value")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(metric,hit)" in plan and "In(job, [0,1])" in plan
    assert "kind" not in plan


# --- Counters ---------------------------------------------------------------


def test_increase_counts_resets_from_zero(counters, rows):
    grown = metrics.sum_increase(counters.filter("metric = 'hit'"), bucket=10)
    assert rows(grown) == [(0, 1, 9.0), (0, 2, 2.0), (10, 1, 96.0)]


def test_rate_by_labels_and_over_all(counters, rows):
    hits = counters.filter("metric = 'hit'")
    assert rows(metrics.sum_rate(hits)) == [(0, 1, 0.9), (0, 2, 0.2), (10, 1, 9.6)]
    assert rows(metrics.sum_rate(hits, by=[])) == [(0, 1.1), (10, 9.6)]


def test_grouping_label_outside_the_series_splits_it(spark, rows):
    df = samples(
        spark, [(0.0, "m", 1, 0, 1, 5.0), (1.0, "m", 1, 0, 2, 50.0), (2.0, "m", 1, 0, 1, 6.0)]
    )
    assert rows(metrics.sum_increase(df, "kind", 10)) == [(0, 1, 1.0)]


def brute_increase(points, seconds):
    total = {}
    ordered = sorted(points)
    for (_, a), (at, b) in zip(ordered, ordered[1:]):
        start = int(at // seconds) * seconds
        total[start] = total.get(start, 0.0) + (b if b < a else b - a)
    return total


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.dictionaries(st.integers(-2000, 4000), st.integers(0, 50), min_size=1, max_size=60),
    st.sampled_from([1, 7, 10, 60]),
)
def test_increase_against_brute_force(spark, points, seconds):
    points = [(at / 100, float(value)) for at, value in points.items()]
    df = samples(spark, [(at, "m", 1, 0, 0, value) for at, value in points])
    grown = metrics.series_increase(df, seconds)
    got = {row.bucket: row.increase for row in grown.collect()}
    assert got == brute_increase(points, seconds)
    assert all(value >= 0 for value in got.values())


def test_every_step_counts_whatever_the_bucket(spark, rows):
    """Growth of 5 every 10 s has its rate in every bucket; sparse samples lose nothing."""
    steady = samples(spark, [(10.0 * i, "m", 1, 0, 0, 5.0 * i) for i in range(101)])
    rates = rows(metrics.sum_rate(steady))
    assert rates == [(10 * i, 1, 0.5) for i in range(1, 101)]
    sparse = samples(spark, [(15.0 * i, "m", 1, 0, 0, 7.0 * i) for i in range(500)])
    for bucket in ("10 seconds", "1 minute", "1 hour"):
        grown = metrics.sum_increase(sparse, bucket=bucket)
        assert grown.agg(F.sum("increase")).first()[0] == 7.0 * 499


def test_pages_carry_the_last_value_over(spark, rows, monkeypatch):
    monkeypatch.setattr(metrics, "PAGE", 16)
    df = samples(spark, [(3.0 * i, "m", None, 0, 0, float(i)) for i in range(200)])
    grown = metrics.series_increase(df, 10)
    assert grown.agg(F.sum("increase")).first()[0] == 199.0


def test_lookback_matches_gauges_scraped_at_different_moments(spark, rows):
    df = samples(spark, [(9.0, "a", 1, 0, 0, 5.0), (12.0, "b", 1, 0, 0, 2.0), (45.0, "b", 1, 0, 0, 1.0)])
    a, b = (df.filter(F.col("metric") == m) for m in "ab")
    assert rows(metrics.binary_op(a, b, "-")) == []
    assert rows(metrics.binary_op(a, b, "-", lookback=2)) == [(10, 1, 0, 3.0)]


def test_an_empty_text_matches_a_missing_label(spark, rows):
    df = spark.createDataFrame([("a", None, 1.0), ("a", "", 2.0), ("a", "x\n", 3.0)], "metric string, zone string, value double")
    assert rows(metrics.select_series(df, "a", {"zone": ""}), "value") == [(1.0,), (2.0,)]
    assert rows(metrics.select_series(df, "a", {"zone": Matching("x")}), "value") == []


def test_ratio_and_hit_rate(counters, rows):
    assert rows(metrics.percent_ratio(counters, "hit", "all")) == [(0, 1, 50.0)]
    both = rows(metrics.hit_rate(counters, "hit", "all"))
    assert both == [(0, pytest.approx((1 - 11 / 18) * 100))]


def test_ratio_equals_the_join_of_two_rates(spark, rows):
    random.seed(5)
    data = [
        (i + 0.5, random.choice("ab"), random.randrange(4), 0, 0, float(random.randrange(90)))
        for i in range(400)
    ]
    df = samples(spark, data)
    ratio = metrics.percent_ratio(df, "a", "b", bucket=100)
    left = metrics.sum_rate(df.filter("metric = 'a'"), bucket=100).withColumnRenamed("rate", "l")
    right = metrics.sum_rate(df.filter("metric = 'b'"), bucket=100).withColumnRenamed("rate", "r")
    joined = left.join(right, ["bucket", "instance"]).selectExpr(
        "bucket", "instance", "try_divide(l, r) * 100"
    )
    for (b1, i1, x), (b2, i2, y) in zip(rows(ratio), rows(joined), strict=True):
        assert (b1, i1) == (b2, i2) and x == pytest.approx(y)


def test_division_by_a_zero_rate_is_null(spark, rows):
    df = samples(
        spark,
        [
            (0.0, "a", 1, 0, 0, 1.0),
            (1.0, "a", 1, 0, 0, 2.0),
            (0.0, "b", 1, 0, 0, 1.0),
            (1.0, "b", 1, 0, 0, 1.0),
        ],
    )
    assert rows(metrics.percent_ratio(df, "a", "b")) == [(0, 1, None)]


# --- Gauges -----------------------------------------------------------------


def test_latest_skips_null_and_breaks_ties(spark, rows):
    df = samples(
        spark,
        [
            (1.0, "m", 1, 0, 1, 5.0),
            (2.0, "m", 1, 0, 2, 6.0),
            (2.0, "m", 1, 0, 3, 7.0),
            (3.0, "m", 1, 0, 4, None),
        ],
    )
    assert rows(metrics.latest(df, tie="kind"), "value") == [(7.0,)]


def test_aggregate(counters, rows):
    assert rows(metrics.aggregate(counters, "min")) == [(0.0,)]
    every = metrics.aggregate(counters.filter("instance = 2"), ["min", "max", "avg", "count"], "metric")
    assert rows(every) == [("hit", 5.0, 7.0, 6.0, 2)]
    with pytest.raises(ValueError):
        metrics.aggregate(counters, "median")


def test_vector_match_drops_the_unmatched(spark, rows):
    a = samples(spark, [(1.0, "a", 1, 0, 0, 9.0), (2.0, "a", 1, 0, 0, 10.0), (1.0, "a", 2, 0, 0, 1.0)])
    b = samples(spark, [(5.0, "b", 1, 0, 0, 4.0), (1.0, "b", 3, 0, 0, 1.0), (15.0, "b", 2, 0, 0, 1.0)])
    assert rows(metrics.binary_op(a, b, "-")) == [(0, 1, 0, 6.0)]
    assert rows(metrics.binary_op(a, b, "/")) == [(0, 1, 0, 2.5)]
    with pytest.raises(ValueError):
        metrics.binary_op(a, b, "%")
    plan = metrics.binary_op(a, b, "-")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_vector_match_rejects_several_series(spark):
    a = samples(spark, [(1.0, "a", 1, 0, 0, 9.0), (2.0, "a", 1, 1, 0, 10.0)])
    with pytest.raises(Exception, match="several series match"):
        metrics.binary_op(a, a, "-", on=["instance"]).collect()


# --- Distributions ----------------------------------------------------------


def test_heatmap_bounds_are_inclusive(spark, rows):
    df = samples(spark, [(s, "m", 1, 0, 0, v) for s, v in [(0.0, 1.0), (1.0, 1.5), (2.0, 9.0), (11.0, 2.0)]])
    inf = float("inf")
    assert rows(metrics.heatmap(df, [2, 1])) == [
        (0, 1.0, 1, 0.1),
        (0, 2.0, 1, 0.1),
        (0, inf, 1, 0.1),
        (10, 2.0, 1, 0.1),
    ]
    assert rows(metrics.heatmap(df, [2, 1], cumulative=True), "bucket", "le", "observations") == [
        (0, 1.0, 1),
        (0, 2.0, 2),
        (0, inf, 3),
        (10, 1.0, 0),
        (10, 2.0, 1),
        (10, inf, 1),
    ]
    with pytest.raises(ValueError):
        metrics.heatmap(df, [])


def test_count_rate(counters, rows):
    assert rows(metrics.count_rate(counters.filter("metric = 'hit'"))) == [
        (0, 1, 4, 0.4),
        (0, 2, 2, 0.2),
        (10, 1, 1, 0.1),
    ]


@pytest.mark.parametrize("q", ["0.75", "95", 0.95, "1.0"])
def test_quantile_accepts_known_values_only(counters, q):
    with pytest.raises(ValueError):
        metrics.quantile(counters, q)


@pytest.mark.parametrize("q", metrics.ACCEPTED_QUANTILES)
@pytest.mark.parametrize("accuracy", [2, 50, 10_000])
def test_exact_quantile_does_not_depend_on_the_sketch(spark, q, accuracy):
    rng = np.random.default_rng(7)
    groups = {
        1: rng.lognormal(0, 4, 900),
        2: np.repeat(5.0, 300),
        3: np.array([42.0]),
        4: np.array([1.0, 2.0]),
        5: np.concatenate([np.repeat(1.0, 500), rng.normal(0, 1, 333)]),
    }
    data = [(int(k), float(v)) for k, values in groups.items() for v in values]
    df = spark.createDataFrame(data, "instance long, value double").repartition(7)
    got = {r.instance: r.value for r in metrics.quantile(df, q, accuracy=accuracy).collect()}
    for k, values in groups.items():
        assert got[k] == pytest.approx(np.quantile(values, float(q)), rel=1e-12), k
    whole = metrics.quantile(df, q, by=(), accuracy=accuracy)
    assert whole.columns == ["value"]
    assert whole.first()[0] == pytest.approx(np.quantile([v for _, v in data], float(q)))


def test_quantile_of_everything_stays_an_equi_join(spark):
    df = spark.range(1000).selectExpr("id % 3 AS instance", "cast(id AS double) AS value")
    whole = metrics.quantile(df, "0.5", by=())
    assert whole.first()[0] == 499.5
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_sketch_quantile_is_a_value_of_the_data(spark):
    df = spark.range(1001).selectExpr("1L AS instance", "cast(id AS double) AS value")
    assert metrics.quantile(df, "0.95", exact=False).first().value == pytest.approx(950, abs=1)


def test_label_values(counters, rows):
    assert rows(metrics.label_values(counters, "hit", "instance")) == [(1,), (2,)]


def test_histogram_kept_as_counters(spark, rows):
    data = [("t_bucket", s, le, v) for s, le, v in [(0, 1.0, 5.0), (9, 1.0, 8.0), (0, 2.0, 6.0), (9, 2.0, 16.0)]]
    df = spark.createDataFrame(data + [("t_count", 0, None, 1.0)], "metric string, s long, le double, value double")
    df = df.selectExpr("timestamp_seconds(s) AS ts", "metric", "1L AS instance", "0L AS job", "le", "value")
    assert rows(metrics.bucket_heatmap(df, "t")) == [(0, 1.0, 0.3), (0, 2.0, 1.0)]


def test_summary_quantile(spark, rows):
    df = spark.createDataFrame(
        [("size", "0.5", 1.0), ("size", "0.999", 2.0), ("other", "0.999", 3.0)],
        "metric string, quantile string, value double",
    )
    assert rows(metrics.summary_quantile(df, "size", "0.999"), "value") == [(2.0,)]
    with pytest.raises(ValueError):
        metrics.summary_quantile(df, "size", "0.75")
