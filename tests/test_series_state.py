"""State of streams against the batch operators, whatever the order of arrival."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chainlake import streaming
from chainlake.operators import blocks, metrics, state

SAMPLE = "sample_id long, ts timestamp, metric string, instance long, job long, value double"
TIMES = "timestamp_seconds(at) as ts"


def samples_of(spark, rows):
    df = spark.createDataFrame(rows, "sample_id long, at long, metric string, instance long, job long, value double")
    return df.selectExpr("sample_id", TIMES, "metric", "instance", "job", "value")


def random_samples(n, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        value = None if rng.random() < 0.05 else float(rng.integers(0, 50))
        instance = None if rng.random() < 0.05 else int(rng.integers(0, 3))
        rows.append((i, int(rng.integers(0, 400)), str(rng.choice(["a", "b"])), instance, 1, value))
    return rows


def arrive(df, path, times):
    """Write each part of the rows as a batch of its own."""
    for n in range(times):
        df.where(F.col("batch") == n).drop("batch").coalesce(1).write.mode("append").parquet(path)


def follow(spark, source, out, checkpoint, **options):
    read = spark.readStream.schema(SAMPLE).option("maxFilesPerTrigger", 1).parquet(source)
    streaming.follow_rates(read, out, checkpoint, bucket=20, tie="sample_id", **options).awaitTermination()


@pytest.mark.parametrize("seed", [1, 2])
def test_rates_in_state_equal_the_batch(spark, folder, rows, seed):
    source, out, checkpoint = folder("in"), folder("out"), folder("check")
    every = samples_of(spark, random_samples(300, seed)).withColumn("batch", F.pmod(F.xxhash64("sample_id", F.lit(seed)), F.lit(4)))
    near = lambda df, *names: [(*r[:-1], round(r[-1], 6)) for r in rows(df, *names)]
    for n in range(4):  # a restart from the checkpoint for each batch
        every.where(F.col("batch") == n).drop("batch").coalesce(1).write.mode("append").parquet(source)
        follow(spark, source, out, checkpoint)
        came = spark.read.schema(SAMPLE).parquet(source)
        for by in (["instance"], ["metric", "job"], []):
            got = near(streaming.read_rates(spark, out, by, 20), "bucket", *by, "rate")
            assert got == near(metrics.sum_rate(came, by, 20, tie="sample_id"), "bucket", *by, "rate")
    ratio = metrics.percent_ratio(came, "a", "b", bucket=20, tie="sample_id").filter("percent is not null")
    found = streaming.read_percent(spark, out, "a", "b").filter("percent is not null")
    assert near(found, "bucket", "instance", "percent") == near(ratio, "bucket", "instance", "percent")
    hits = metrics.hit_rate(came, "a", "b", bucket=20, tie="sample_id").filter("hit_rate is not null")
    found = streaming.read_hit_rate(spark, out, "a", "b").filter("hit_rate is not null")
    assert near(found, "bucket", "hit_rate") == near(hits, "bucket", "hit_rate")
    assert streaming.read_late(spark, out).count() == 0


def test_closed_buckets_leave_one_sample(spark, folder, rows):
    """State stays bounded; what comes too late is counted and nothing else."""
    source, out, checkpoint = folder("in"), folder("out"), folder("check")
    ordered = [(i, 5 * i, "a", 1, 1, float((7 * i) % 23)) for i in range(200)]
    for n in range(4):
        some = ordered[50 * n : 50 * n + 50] + ([(900, 3, "a", 1, 1, 5.0), (901, 4, "a", 1, 1, 6.0)] if n == 3 else [])
        samples_of(spark, some).coalesce(1).write.mode("append").parquet(source)
        follow(spark, source, out, checkpoint, keep=60)
    batch = metrics.sum_rate(samples_of(spark, ordered), bucket=20, tie="sample_id")
    near = lambda df: [(*r[:-1], round(r[-1], 6)) for r in rows(df, "bucket", "instance", "rate")]
    assert near(streaming.read_rates(spark, out, bucket=20)) == near(batch)
    assert rows(streaming.read_late(spark, out)) == [(0, 2)]
    stored = spark.read.format("statestore").option("stateVarName", "open").load(checkpoint)
    assert stored.count() <= 4


def test_state_store_holds_the_latest_rows(spark, folder, rows):
    rng = np.random.default_rng(4)
    changes = [(None if k == 5 else int(k), i, float(v), f"v{i}") for i, (k, v) in enumerate(zip(rng.integers(0, 6, 400), rng.random(400)))]
    schema = "account long, seqno long, value double, note string"
    source, checkpoint = folder("in"), folder("check")
    for part in (changes[250:], changes[:100], changes[100:250]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        streaming.follow_state_store(stream, checkpoint).awaitTermination()
        want = state.latest_state(spark.read.schema(schema).parquet(source))
        assert rows(streaming.read_state_store(spark, checkpoint), *want.columns) == rows(want)
    assert streaming.read_state_store(spark, checkpoint, batch=0).count() == len({c[0] for c in changes[250:]})


def test_archives_are_emitted_once_when_they_close(spark, folder, rows):
    schema = "seqno long, bytes long"
    source, out, checkpoint = folder("in"), folder("out"), folder("check")
    parts = [[(i, i) for i in range(0, 25)], [(i, i) for i in range(25, 31)], [(55, 1), (31, 7), (30, None)], [(56, 1)]]
    for n, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        for _ in range(2):  # the second start has nothing to do
            streaming.follow_closed_archives(stream, out, checkpoint, 10, "bytes").awaitTermination()
        came = spark.read.schema(schema).parquet(source)
        batch = blocks.archive_catalog(blocks.bundle(came, 10), "bytes").filter("closed").drop("closed")
        if n == 0:
            assert [r[0] for r in rows(batch)] == [0, 10]
        got = spark.read.parquet(out).drop("batch_id")
        assert rows(got, *batch.columns) == rows(batch)


def test_lower_sources_wait_for_better_ones(spark, folder, rows):
    """Any order of arrival within the limit gives what the batch merge gives."""
    from chainlake.sources import merge_sources

    schema = "seqno long, ts timestamp, payload string"
    keys = {0: [1, 2, 3, 3, 9], 1: [2, 3, 4, 5, 5, 8], 2: list(range(1, 8))}
    rng = np.random.default_rng(7)
    everything = [(p, k, 100 + k, f"{p}:{k}:{n}") for p, own in keys.items() for n, k in enumerate(own)]
    folders, out, checkpoint = [folder(f"in{p}") for p in range(3)], folder("out"), folder("check")
    batches = 4
    arrival = rng.integers(0, batches, len(everything))

    def put(p, rows_of):
        df = spark.createDataFrame(rows_of, "seqno long, at long, payload string").selectExpr("seqno", TIMES, "payload")
        df.coalesce(1).write.mode("append").parquet(folders[p])

    def go():
        streams = [spark.readStream.schema(schema).parquet(f) for f in folders]
        streaming.follow_merged(streams, out, checkpoint, wait="1 hour", lateness="1 hour").awaitTermination()

    for b in range(batches):
        for p in range(3):
            put(p, [(k, t, text) for (q, k, t, text), a in zip(everything, arrival) if q == p and a == b])
        go()
    every = [spark.read.schema(schema).parquet(f) for f in folders]
    want = [tuple(r) for r in rows(merge_sources(every), "seqno", "priority", "payload")]
    taken = rows(spark.read.parquet(out), "seqno", "priority", "payload")
    waiting = rows(streaming.read_waiting(spark, checkpoint), "seqno", "priority", "payload")
    assert sorted(taken + waiting) == want and {r[1] for r in taken} == {0}
    # once the limit has passed, what waits is taken from where it is
    put(0, [(1000, 100_000, "later")])
    go()
    taken = rows(spark.read.parquet(out), "seqno", "priority", "payload")
    assert taken == sorted([*want, (1000, 0, "later")])
