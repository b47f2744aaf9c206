"""One key holds a third of all rows or more: results stay whole, work stays split."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from chainlake import integrity, metrics, objects, sources, state
from chainlake.plans import views
from chainlake.plans.oracles import ORACLES
from chainlake.plans.registry import QUERIES
from tools.check import rows_of


@pytest.fixture
def sort_merge_only(spark):
    """Joins without broadcast, as with sides beyond the threshold."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def fullest_share(df):
    """Share of the rows in the fullest partition."""
    counts = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(counts) / sum(counts)


def test_parts_of_a_hot_object_are_spread(spark, sort_merge_only):
    chunks = spark.range(6000).select(
        F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 50 + 1).alias("object_id"),
        F.col("id").alias("chunk_no"),
        F.encode(F.repeat(F.lit("ab"), 50), "utf-8").alias("data"),
    )
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        parts = objects.rechunk(chunks, 100)
        assert fullest_share(parts) < 0.4  # four shuffle partitions
        etags = integrity.composite_etag(integrity.part_md5(parts), fan_in=16)
        sizes = {r.object_id: r["size"] for r in etags.collect()}
    finally:
        spark.conf.set(coalesce, "true")
    assert sizes[0] == 4000 * 100
    assert sum(sizes.values()) == 6000 * 100


def test_offsets_of_a_hot_object_against_brute_force(spark, rows):
    rng = np.random.default_rng(3)
    lengths = rng.integers(0, 50, 3000)
    data = [(0, n, bytes(int(size))) for n, size in enumerate(lengths)]
    chunks = spark.createDataFrame(data, "object_id long, chunk_no long, data binary").repartition(7)
    got = rows(objects.chunk_offsets(chunks, span=100), "chunk_no", "offset")
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    assert got == [(n, int(at)) for n, at in enumerate(starts)]


def test_a_hot_series_is_split_by_slot(spark):
    df = spark.range(5000).select(
        F.timestamp_millis(F.col("id") * 10).alias("ts"),
        F.lit("m").alias("metric"),
        F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 40).alias("instance"),
        F.lit(0).alias("job"),
        (F.col("id") % 17).cast("double").alias("value"),
    )
    grown = metrics.series_increase(df, 10)
    plan = grown._jdf.queryExecution().executedPlan().toString()
    first = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line][-1]
    assert "_slot" in first
    expected = {}
    points = {}
    for row in df.collect():
        points.setdefault(row.instance, []).append((row.ts.timestamp(), row.value))
    for instance, values in points.items():
        ordered = sorted(values)
        for (_, a), (at, b) in zip(ordered, ordered[1:]):
            bucket = (instance, int(at // 10) * 10)
            expected[bucket] = expected.get(bucket, 0.0) + (b if b < a else b - a)
    got = {(r.instance, r.bucket): r.increase for r in grown.collect()}
    assert got == pytest.approx(expected)


def test_a_constant_hot_group_is_spread_over_the_salts(spark):
    df = spark.range(9000).select(F.lit(0).alias("instance"), F.lit(5.0).alias("value"))
    plan = metrics.quantile(df, "0.99")._jdf.queryExecution().analyzed().toString()
    assert "monotonically_increasing_id" in plan
    salted = df.withColumn("salt", F.monotonically_increasing_id() % metrics.SALTS)
    assert salted.select("salt").distinct().count() >= metrics.SALTS / 2


@pytest.mark.parametrize("copies", [True, False])
def test_quantile_of_a_hot_group(spark, sort_merge_only, copies):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 40).alias("instance"),
        (F.lit(5.0) if copies else F.col("id") * 1.5).alias("value"),
    )
    groups = {}
    for row in df.collect():
        groups.setdefault(row.instance, []).append(row.value)
    got = {r.instance: r.value for r in metrics.quantile(df, "0.99", accuracy=100).collect()}
    assert got == pytest.approx({k: np.quantile(v, 0.99) for k, v in groups.items()})


def test_hot_account_and_hot_block(spark, rows):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 10).alias("account"),
        F.col("id").alias("seqno"),
    )
    latest = {r.account: r.seqno for r in state.latest_state(df).collect()}
    assert latest[0] == 29998
    plan = state.latest_state(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "SortAggregate" not in plan

    wide = df.withColumns({"lt": F.col("seqno"), "payload": F.lit("x")})
    plan = state.latest_state(wide, order=["seqno", "lt"])._jdf.queryExecution().executedPlan().toString()
    partial = next(line for line in plan.splitlines() if "partial_" in line)
    assert partial.count("partial_") == 1 and partial.count("payload") == 1

    copies = [df.selectExpr("account AS seqno", "'x' AS payload").distinct() for _ in range(2)]
    merged = sources.merge_sources(copies)
    assert merged.count() == 10
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(priority" in plan and "SortAggregate" not in plan


def test_an_order_with_a_third_of_all_lines_is_spread_over_shards(spark, folder):
    sf_dir = folder("hot")
    lines = views.table(spark, "/root/testdata/sf0.001", "lineitem")
    hot = F.when(F.col("l_linenumber") <= 2, 1).otherwise(F.col("l_orderkey")).cast("long")
    lines.withColumn("l_orderkey", hot).coalesce(1).write.parquet(f"{sf_dir}/lineitem.parquet")
    views.table(spark, "/root/testdata/sf0.001", "orders").write.parquet(f"{sf_dir}/orders.parquet")

    duck = duckdb.connect()
    for name in ("lineitem", "orders"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet/*.parquet'")
    for name in ("block_source", "flatten_transactions"):
        df = QUERIES[name](spark, sf_dir)
        result = duck.execute(ORACLES[name])
        names = [column[0] for column in result.description]
        assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, result.fetchall())
    blocks = QUERIES["block_source"](spark, sf_dir).where("seqno = 1").collect()
    total = sum(r.transactions for r in blocks)
    assert total > lines.count() / 4
    assert max(r.transactions for r in blocks) == views.BLOCK_LINES
    assert len(blocks) == -(-total // views.BLOCK_LINES)


def test_blocks_of_a_hot_order_are_bounded_at_every_size(spark):
    """Two million lines of one order, a third of them equal, in blocks of ten thousand."""
    lines = spark.range(3_000_000).select(
        F.when(F.col("id") % 3 < 2, 1).otherwise(F.col("id")).alias("seqno"),
        F.lit(7).cast("long").alias("part"),
        F.col("id").alias("lt"),
        F.lit(0).cast("long").alias("now"),
        F.encode(F.when(F.col("id") % 3 == 1, F.col("id").cast("string")).otherwise("same"), "utf-8").alias("payload"),
    )
    sizes = views.in_shards(lines, 10_000).groupBy("seqno", "shard").count()
    hot = sizes.where("seqno = 1").collect()
    assert sorted(r.shard for r in hot) == list(range(200)) and {r["count"] for r in hot} == {10_000}
    assert sizes.where("seqno <> 1 and (shard <> 0 or count <> 1)").isEmpty()


def test_no_plan_holds_a_cross_join(spark):
    """Nested-loop joins appear in no plan that is built lazily."""
    eager = ("stream", "ship", "archive", "snapshot", "fan_out", "backlog", "noop", "source")
    for name, query in QUERIES.items():
        if any(word in name for word in eager) and name != "merge_sources":
            continue
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name
