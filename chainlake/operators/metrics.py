"""Questions over labelled samples: selections, rates, ratios, distributions.

A sample has ``ts``, ``metric``, ``value`` and label columns; a label may also
live in a ``labels`` map. A *series* is one combination of labels. Times in
results are bucket starts in epoch seconds.

A counter's increase is counted between neighbouring samples of a series, however
far apart, and belongs to the bucket of the later one; a smaller value than before is
a reset and counts from zero. So the increases of all buckets add up to the whole
growth for any length of bucket. Nothing is extrapolated to the edges of a bucket.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import bucket_start, seconds_of
from .common import columns, floor_div

# Fixed values.
ACCEPTED_QUANTILES = ("0", "0.5", "0.9", "0.95", "0.99", "0.999", "1")
DEFAULT_QUANTILE = "0.95"
RATE_INTERVAL = "10 seconds"
ALL_VALUES = ".*"

#: Labels that tell series apart when a call does not say otherwise.
SERIES = ("metric", "instance", "job")

#: A series is cut into slots of time whose samples are put in order together: of ``PAGE``
#: seconds, or a sixty-fourth of a longer bucket. They shape the work and not the result.
SLOTS, PAGE = 64, 900


@dataclass(frozen=True)
class Matching:
    """A label matcher by regular expression, anchored at both ends."""

    pattern: str


def label(df: DataFrame, name: str) -> Column:
    """The label's column, or its entry in the ``labels`` map."""
    if name in df.columns:
        return F.col(name)
    if "labels" in df.columns:
        return F.col("labels")[name]
    raise ValueError(f"no label {name!r} in {df.columns}")


def promote_labels(df: DataFrame, names: str | Sequence[str]) -> DataFrame:
    """Turn entries of the ``labels`` map into columns, to group and match by them."""
    return df.withColumns({name: label(df, name) for name in columns(names)})


def select_series(
    df: DataFrame, metric: str | Sequence[str], matchers: Mapping | None = None
) -> DataFrame:
    """Samples of one or several metrics whose labels match.

    A matcher is a value (equal), a list of values (any of them) or
    :class:`Matching`. The pattern ``.*`` matches every series, with or without
    the label, and an empty text those without it. Equality and lists are pushed
    into the scan.
    """
    if isinstance(metric, str):
        selected = df.filter(F.col("metric") == metric)
    elif isinstance(metric, (list, tuple)) and all(isinstance(m, str) for m in metric):
        selected = df.filter(F.col("metric").isin(*metric))
    else:
        raise TypeError("metric must be a text or a list of texts")
    for name, wanted in (matchers or {}).items():
        column = label(df, name)
        if isinstance(wanted, Matching):
            if wanted.pattern == ALL_VALUES:
                continue
            text = F.coalesce(column.cast("string"), F.lit(""))
            selected = selected.filter(text.rlike(f"\\A(?:{wanted.pattern})\\z"))
        elif isinstance(wanted, (list, tuple)):
            matches = column.isin(*wanted)
            selected = selected.filter(matches | column.isNull() if "" in wanted else matches)
        elif isinstance(wanted, (str, int, float)):
            matches = column == wanted
            selected = selected.filter(matches | column.isNull() if wanted == "" else matches)
        else:
            raise TypeError(f"matcher of {name!r} must be a value, a list or Matching")
    return selected


def moment(tie: str | None) -> Column:
    """Ordering of samples in time for ``max_by``.

    Time and tie-break are packed into one number. A fixed-width ordering keeps
    the aggregate on the hash path, where a struct would have every task sort all
    of its samples first. ``tie`` must be a whole-number column.
    """
    if tie is None:
        return F.col("ts")
    micros = F.unix_micros("ts").cast("decimal(18,0)")
    return micros * F.lit(Decimal(2**64)) + F.col(tie)


# --- Counters ---------------------------------------------------------------


def _gain(value: Column, previous: Column) -> Column:
    """Increase from the previous sample; null for the first one."""
    return F.when(value < previous, value).otherwise(value - previous)


def _steps(
    df: DataFrame, bucket: str | int, series: Sequence[str], tie: str | None
) -> DataFrame:
    """``bucket, series…, _gain``: what the steps between neighbouring samples add.

    Each series is split into time slots, whose samples are ordered apart from each
    other; only the ends of a slot go on, to be ordered by series. A slot holds minutes of
    one series, and a series has some tens of thousands of slots a year, so neither a
    busy series nor a long one makes a large task. Samples are shuffled once.
    """
    seconds = seconds_of(bucket)
    slot = floor_div(F.unix_micros("ts"), max(PAGE, seconds // SLOTS) * 1_000_000)
    by_time = ["ts", tie] if tie else ["ts"]
    dealt = (
        df.filter(F.col("value").isNotNull())
        .select(*series, *by_time, "value", slot.alias("_slot"))
        .repartition("_slot", *series)
    )
    in_slot = Window.partitionBy("_slot", *series).orderBy(*by_time)
    inside = dealt.select("ts", *series, _gain(F.col("value"), F.lag("value").over(in_slot)).alias("_gain"))
    ends = dealt.groupBy("_slot", *series).agg(
        F.min("ts").alias("ts"),
        F.min_by("value", moment(tie)).alias("_first"),
        F.max_by("value", moment(tie)).alias("_last"),
    )
    over_slots = Window.partitionBy(*series).orderBy("_slot")
    between = ends.select("ts", *series, _gain(F.col("_first"), F.lag("_last").over(over_slots)).alias("_gain"))
    steps = inside.unionByName(between).filter(F.col("_gain").isNotNull())
    return steps.select(bucket_start("ts", bucket).alias("bucket"), *series, "_gain")


def series_increase(
    df: DataFrame,
    bucket: str | int,
    series: Sequence[str] = SERIES,
    tie: str | None = None,
) -> DataFrame:
    """``bucket, series…, increase``: the increase of each series per bucket.

    A bucket has a row if one of its samples has another before it.
    """
    series = columns(series)
    return _steps(df, bucket, series, tie).groupBy("bucket", *series).agg(F.sum("_gain").alias("increase"))


def sum_increase(
    df: DataFrame,
    by: str | Sequence[str] = "instance",
    bucket: str | int = RATE_INTERVAL,
    series: Sequence[str] = SERIES,
    tie: str | None = None,
) -> DataFrame:
    """``bucket, by…, increase`` summed over series; ``by=[]`` sums all."""
    by = columns(by)
    steps = _steps(df, bucket, _with_labels(series, by), tie)
    return steps.groupBy("bucket", *by).agg(F.sum("_gain").alias("increase"))


def sum_rate(
    df: DataFrame,
    by: str | Sequence[str] = "instance",
    bucket: str | int = RATE_INTERVAL,
    series: Sequence[str] = SERIES,
    tie: str | None = None,
) -> DataFrame:
    """``bucket, by…, rate``: the summed increase per second."""
    grown = sum_increase(df, by, bucket, series, tie)
    rate = F.col("increase") / seconds_of(bucket)
    return grown.withColumn("rate", rate).drop("increase")


def _with_labels(series: Sequence[str], by: Sequence[str]) -> list[str]:
    """Series labels plus the grouping labels they lack."""
    return [*columns(series), *(name for name in by if name not in series)]


def _paired_increase(
    df: DataFrame, left: str, right: str, by: list[str], bucket, series, tie
) -> DataFrame:
    """Summed increases of two metrics side by side, in one pass over the data."""
    both = select_series(df, [left, right])
    labels = _with_labels(_with_labels(series, ["metric"]), by)
    grown = _steps(both, bucket, labels, tie)

    def total(metric: str) -> Column:
        return F.sum(F.when(F.col("metric") == metric, F.col("_gain")))

    sides = grown.groupBy("bucket", *by).agg(
        total(left).alias("_left"), total(right).alias("_right")
    )
    # Like an inner match of the two rates: a group with one side only drops out.
    return sides.filter(F.col("_left").isNotNull() & F.col("_right").isNotNull())


def percent_ratio(
    df: DataFrame,
    numerator: str,
    denominator: str,
    by: str | Sequence[str] = "instance",
    bucket: str | int = RATE_INTERVAL,
    series: Sequence[str] = SERIES,
    tie: str | None = None,
) -> DataFrame:
    """``bucket, by…, percent``: rate of one counter in percent of another.

    The seconds cancel out. Division by a zero rate gives null.
    """
    by = columns(by)
    sides = _paired_increase(df, numerator, denominator, by, bucket, series, tie)
    percent = F.try_divide("_left", "_right") * 100
    return sides.select("bucket", *by, percent.alias("percent"))


def hit_rate(
    df: DataFrame,
    miss: str,
    total: str,
    by: str | Sequence[str] = (),
    bucket: str | int = RATE_INTERVAL,
    series: Sequence[str] = SERIES,
    tie: str | None = None,
) -> DataFrame:
    """``bucket, by…, hit_rate``: percent of calls that were no miss."""
    by = columns(by)
    sides = _paired_increase(df, miss, total, by, bucket, series, tie)
    rate = (1 - F.try_divide("_left", "_right")) * 100
    return sides.select("bucket", *by, rate.alias("hit_rate"))


# --- Gauges -----------------------------------------------------------------


def latest(
    df: DataFrame, by: str | Sequence[str] = SERIES, tie: str | None = None
) -> DataFrame:
    """``by…, ts, value``: the last sample of each series that is not null."""
    by = columns(by)
    return (
        df.filter(F.col("value").isNotNull())
        .groupBy(*by)
        .agg(F.max("ts").alias("ts"), F.max_by("value", moment(tie)).alias("value"))
    )


# The accepted functions across series.
AGGREGATES = {
    "min": F.min,
    "max": F.max,
    "avg": F.avg,
    "sum": F.sum,
    "count": F.count,
}


def aggregate(
    df: DataFrame, fn: str | Sequence[str], by: str | Sequence[str] = ()
) -> DataFrame:
    """Aggregate values across series; ``by=()`` gives one global row.

    The result column is named after the function.
    """
    names = columns(fn)
    unknown = [name for name in names if name not in AGGREGATES]
    if unknown:
        raise ValueError(f"unknown functions {unknown}, accepted: {sorted(AGGREGATES)}")
    return df.groupBy(*columns(by)).agg(*(AGGREGATES[n]("value").alias(n) for n in names))


# The accepted arithmetic between two vectors.
OPERATORS = {
    "+": lambda a, b: a + b,
    "-": lambda a, b: a - b,
    "*": lambda a, b: a * b,
    "/": F.try_divide,
}


def _instant(
    df: DataFrame, on: list[str], bucket, series: Sequence[str], tie: str | None
) -> DataFrame:
    """Latest value per bucket and ``on``; more than one series there is an error."""
    extra = [name for name in columns(series) if name not in on]
    value = F.max_by("value", moment(tie))
    if extra:
        identity = F.xxhash64(*extra)  # fixed width, for the hash path
        value = F.when(F.min(identity).eqNullSafe(F.max(identity)), value).otherwise(
            F.raise_error(F.lit("several series match the same labels")).cast("double")
        )
    return (
        df.filter(F.col("value").isNotNull())
        .withColumn("bucket", bucket_start("ts", bucket))
        .groupBy("bucket", *on)
        .agg(value.alias("value"))
    )


def binary_op(
    a: DataFrame,
    b: DataFrame,
    op: str,
    on: str | Sequence[str] = ("instance", "job"),
    bucket: str | int = RATE_INTERVAL,
    series: Sequence[str] = SERIES,
    tie: str | None = None,
    lookback: int = 0,
) -> DataFrame:
    """``bucket, on…, value`` of ``a <op> b``, matched one to one on labels.

    Both sides are reduced to their latest sample per bucket before the join, so
    it is a plain equi-join of one row per key. Unmatched rows drop out; several
    series for one key fail the query. Division by zero gives null.

    With ``lookback``, a value also holds in so many buckets after its own that have
    none of their own. Buckets in which neither side has a sample have no row, so there
    are no more rows than samples, however far one looks back: both sides lie together
    by key and page of time, the last value goes on inside a page, and what a page ends
    with is joined to the next one. No key has to be put in order as a whole.
    """
    if op not in OPERATORS:
        raise ValueError(f"unknown operator {op!r}, accepted: {list(OPERATORS)}")
    on = columns(on)
    left, right = (_instant(side, on, bucket, series, tie) for side in (a, b))
    value = OPERATORS[op](F.col("_left"), F.col("_right"))
    if lookback:
        met = _as_of(left, right, on, seconds_of(bucket), lookback)
    else:
        met = left.withColumnRenamed("value", "_left").join(right.withColumnRenamed("value", "_right"), ["bucket", *on])
    return met.select("bucket", *on, value.alias("value"))


#: Buckets in a page of aligned values, unless one looks back further.
ALIGNED = 1024


def _as_of(left: DataFrame, right: DataFrame, on: list[str], seconds: int, lookback: int) -> DataFrame:
    """``bucket, on…, _left, _right``: the last value of each side, if it is young enough.

    A page is at least as long as the look back, so only the page before can matter.
    """
    sides = {"_left": left, "_right": right}
    nothing = F.lit(None).cast("double")
    both = [df.select("bucket", *on, *((F.col("value") if n == own else nothing).alias(n) for n in sides)) for own, df in sides.items()]
    page = floor_div(F.col("bucket"), max(ALIGNED, lookback) * seconds).alias("_page")
    labelled = reduce(lambda keep, n: keep & F.col(n).isNotNull(), on, F.lit(True))  # a null label matches none
    rows = (
        both[0].unionByName(both[1])
        .filter(labelled)
        .select("bucket", *on, *sides, page)
        .repartition(*on, "_page")
        .groupBy(*on, "_page", "bucket")
        .agg(*(F.max(n).alias(n) for n in sides))
    )
    last = lambda n: F.when(F.col(n).isNotNull(), F.struct("bucket", F.col(n).alias("value")))
    ends = rows.groupBy(*on, "_page").agg(*(F.max(last(n)).alias(f"{n}_before") for n in sides))
    before = ends.withColumn("_page", F.col("_page") + 1)
    so_far = Window.partitionBy(*on, "_page").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    carried = rows.withColumns({f"{n}_held": F.last(last(n), ignorenulls=True).over(so_far) for n in sides})
    met = carried.join(before, [*on, "_page"], "left")
    held = {n: F.coalesce(f"{n}_held", f"{n}_before") for n in sides}
    for n, found in held.items():
        young = F.col("bucket") - found["bucket"] <= lookback * seconds
        met = met.withColumn(f"{n}_value", F.when(young, found["value"]))
    met = met.filter(F.col("_left_value").isNotNull() & F.col("_right_value").isNotNull())
    return met.select("bucket", *on, F.col("_left_value").alias("_left"), F.col("_right_value").alias("_right"))


# --- Distributions ----------------------------------------------------------


def _tumbling(bucket: str | int) -> Column:
    """Tumbling window key; on a stream it lets the watermark close buckets."""
    return F.window("ts", f"{seconds_of(bucket)} seconds").alias("_window")


def _window_bucket() -> Column:
    return F.unix_seconds("_window.start").alias("bucket")


def heatmap(
    df: DataFrame,
    bounds: Sequence[float],
    bucket: str | int = RATE_INTERVAL,
    by: str | Sequence[str] = (),
    cumulative: bool = False,
) -> DataFrame:
    """``bucket, by…, le, observations, rate`` of a histogram over time.

    ``bounds`` are inclusive upper bounds; ``+Inf`` is added. Without
    ``cumulative`` only cells that hold observations are returned. With it every
    bound of a bucket is returned and counts all observations up to it. Runs on
    streams; set a watermark on ``ts`` for append mode.
    """
    bounds = sorted(float(b) for b in bounds)
    if not bounds:
        raise ValueError("at least one bound is needed")
    by = columns(by)
    observed = df.filter(F.col("value").isNotNull())
    if cumulative:
        cells = [
            F.struct(
                F.lit(top).alias("le"), F.count_if(F.col("value") <= top).alias("observations")
            )
            for top in [*bounds, float("inf")]
        ]
        counted = observed.groupBy(_tumbling(bucket), *by).agg(F.array(*cells).alias("_cells"))
        counted = counted.select("_window", *by, F.inline("_cells"))
    else:
        le = reduce(
            lambda rest, top: F.when(F.col("value") <= top, F.lit(top)).otherwise(rest),
            reversed(bounds),
            F.lit(float("inf")),
        )
        counted = (
            observed.withColumn("le", le)
            .groupBy(_tumbling(bucket), *by, "le")
            .agg(F.count(F.lit(1)).alias("observations"))
        )
    return counted.select(
        _window_bucket(),
        *by,
        "le",
        "observations",
        (F.col("observations") / seconds_of(bucket)).alias("rate"),
    )


def bucket_heatmap(
    df: DataFrame,
    metric: str,
    bucket: str | int = RATE_INTERVAL,
    by: str | Sequence[str] = (),
    series: Sequence[str] = SERIES,
    tie: str | None = None,
) -> DataFrame:
    """``bucket, by…, le, rate`` of a histogram already kept as counters.

    The samples of ``<metric>_bucket`` carry their upper bound in the label
    ``le``; each bound is a counter of its own.
    """
    counters = select_series(df, f"{metric}_bucket")
    return sum_rate(counters, [*columns(by), "le"], bucket, series, tie)


def count_rate(
    df: DataFrame, by: str | Sequence[str] = "instance", bucket: str | int = RATE_INTERVAL
) -> DataFrame:
    """``bucket, by…, observations, rate``: observations per second.

    Runs on streams as :func:`heatmap` does.
    """
    by = columns(by)
    return (
        df.filter(F.col("value").isNotNull())
        .groupBy(_tumbling(bucket), *by)
        .agg(F.count(F.lit(1)).alias("observations"))
        .select(
            _window_bucket(),
            *by,
            "observations",
            (F.col("observations") / seconds_of(bucket)).alias("rate"),
        )
    )


def check_quantile(q: str) -> str:
    """The quantile if it is an accepted one, else ``ValueError``."""
    if q not in ACCEPTED_QUANTILES:
        raise ValueError(f"quantile must be one of {', '.join(ACCEPTED_QUANTILES)}")
    return q


def summary_quantile(df: DataFrame, metric: str, q: str = DEFAULT_QUANTILE) -> DataFrame:
    """Samples of a summary's own quantile, kept under the label ``quantile``."""
    return select_series(df, metric, {"quantile": check_quantile(q)})


#: Sketch accuracy of the bracket in the exact quantile.
SKETCH_ACCURACY = 10_000

#: Cells the bracket is cut into, and copies of a group's facts in a join.
CELLS = 1024
SALTS = 64


def quantile(
    df: DataFrame,
    q: str = DEFAULT_QUANTILE,
    by: str | Sequence[str] = "instance",
    exact: bool = True,
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """``by…, value``: a quantile per group, interpolated between neighbours.

    ``q`` is one of :data:`ACCEPTED_QUANTILES`. ``exact=False`` returns the value
    of a mergeable sketch instead.

    The exact form never brings a whole group together. A sketch brackets the
    wanted rank and the bracket is cut into cells; counting rows per cell tells
    the cell of the rank, and only the rows of that cell go on, folded by equal
    value. A bad bracket costs time but cannot change the result, as the cells
    cover all values. The counts are partial aggregates; the joins are salted, so
    that a group too large for one task can be split where its facts are too many
    to be broadcast.
    """
    share = float(check_quantile(q))
    by = columns(by)
    rows = df.filter(F.col("value").isNotNull()).select(*by, "value")
    if not exact:
        sketch = F.percentile_approx("value", share, accuracy)
        return rows.groupBy(*by).agg(sketch.alias("value"))
    return _exact_quantile(rows, share, by, accuracy)


def _cell() -> Column:
    """Cell of a value: 0 below the bracket, then its cells, then all above."""
    low, high, value = F.col("_low"), F.col("_high"), F.col("value")
    inner = F.floor(F.coalesce(F.try_divide(value - low, high - low), F.lit(0.0)) * CELLS)
    return (
        F.when(value < low, F.lit(0))
        .when(value > high, F.lit(CELLS + 1))
        .otherwise(F.least(inner, F.lit(CELLS - 1)).cast("int") + 1)
    )


def _exact_quantile(
    rows: DataFrame, share: float, by: list[str], accuracy: int
) -> DataFrame:
    # By place in the scan, so that equal values are spread, too; the scan gives a
    # repeated task the same places.
    salted = rows.withColumn("_salt", (F.monotonically_increasing_id() % SALTS).cast("int"))

    def with_facts(facts: DataFrame) -> DataFrame:
        copies = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        # Without labels there is one row of facts, so its copies can be sent around.
        return salted.join(copies if by else F.broadcast(copies), [*by, "_salt"])

    margin = 2.0 / accuracy
    ends = [max(share - margin, 0.0), min(share + margin, 1.0)]
    bracket = (
        rows.groupBy(*by)
        .agg(F.percentile_approx("value", ends, accuracy).alias("_ends"))
        .select(*by, F.col("_ends")[0].alias("_low"), F.col("_ends")[1].alias("_high"))
    )
    group = Window.partitionBy(*by)
    up_to = group.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lower, upper = F.floor("_place"), F.ceil("_place")
    begin = F.col("_end") - F.col("_count")

    def holds(rank: Column) -> Column:
        return (begin <= rank) & (rank < F.col("_end"))

    # At most CELLS + 2 counts per group, one or two of which hold the ranks.
    wanted = (
        with_facts(bracket)
        .groupBy(*by, "_low", "_high", _cell().alias("_cell"))
        .agg(F.count(F.lit(1)).alias("_count"))
        .withColumn("_end", F.sum("_count").over(up_to.orderBy("_cell")))
        .withColumn("_place", F.lit(share) * (F.sum("_count").over(group) - 1))
        .filter(holds(lower) | holds(upper))
        .groupBy(*by, "_low", "_high", "_place")
        .agg(
            F.min("_cell").alias("_from"),
            F.max("_cell").alias("_to"),
            F.min(begin).alias("_base"),
        )
    )
    ranked = (
        with_facts(wanted)
        .filter(_cell().between(F.col("_from"), F.col("_to")))
        .groupBy(*by, "_place", "_base", "value")
        .agg(F.count(F.lit(1)).alias("_count"))
        .withColumn("_end", F.col("_base") + F.sum("_count").over(up_to.orderBy("value")))
    )

    def value_at(rank: Column) -> Column:
        return F.max(F.when(holds(rank), F.col("value")))

    low, high = value_at(lower), value_at(upper)
    weight = F.max(F.col("_place") - lower)
    return ranked.groupBy(*by).agg((low + weight * (high - low)).alias("value"))


def label_values(df: DataFrame, metric: str, name: str) -> DataFrame:
    """Distinct values of a label of a metric, null left out."""
    values = select_series(df, metric).select(label(df, name).alias(name))
    return values.filter(F.col(name).isNotNull()).distinct()
