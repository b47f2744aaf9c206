"""Streams end in the same tables as batches."""

import pytest
from pyspark.sql import functions as F

from chainlake import blocks, metrics, scratch_dir, sinks, sources, state, streaming
from chainlake.schemas import BLOCK, SAMPLE


def add_file(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def samples(spark, data):
    return spark.createDataFrame(data, "sample_id long, us long, metric string, instance long, value double").select(
        "sample_id",
        F.timestamp_micros("us").alias("ts"),
        "metric",
        "instance",
        F.lit(0).cast("long").alias("job"),
        F.lit(0).cast("long").alias("kind"),
        "value",
    )


def sample_rows(first, count):
    return [
        (i, i * 700_000, "m", i % 3, float((i * 37) % 11)) for i in range(first, first + count)
    ]


def run_to_table(spark, df, folder):
    out = folder("out")
    query = (
        df.writeStream.format("parquet")
        .option("checkpointLocation", folder("checkpoint"))
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


@pytest.fixture(scope="module")
def sample_files(spark):
    """Five files; the last row pushes the watermark past all buckets of interest."""
    path = scratch_dir(spark, "samples")
    for n in range(4):
        add_file(samples(spark, sample_rows(n * 50, 50)), path)
    add_file(samples(spark, [(999, 10_000_000_000, "m", 0, 1.0)]), path)
    return path


@pytest.fixture
def unordered_files(spark, folder):
    """Files out of time order, one of them far behind, one sample repeated in time."""
    path = folder("samples")
    for n in (3, 0, 2):
        add_file(samples(spark, sample_rows(n * 50, 50)), path)
    add_file(samples(spark, [(999, 10_000_000_000, "m", 0, 1.0)]), path)
    add_file(samples(spark, sample_rows(50, 50)), path)
    add_file(samples(spark, [(1000, 700_000, "m", 1, 9.0)]), path)
    return path


def one_by_one(spark, path):
    return spark.readStream.schema(SAMPLE).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_rate_equals_batch_in_every_bucket(spark, rows, folder, unordered_files):
    log = folder("log")
    stream = one_by_one(spark, unordered_files)
    streaming.follow_samples(stream, log, folder("checkpoint"), tie="sample_id").awaitTermination()
    assert spark.read.parquet(log).select("batch_id").distinct().count() == 6
    got = streaming.read_rate(spark, log, tie="sample_id")
    batch = metrics.sum_rate(spark.read.parquet(unordered_files), tie="sample_id")
    want = rows(batch, "bucket", "instance", "rate")
    assert rows(got, "bucket", "instance", "rate") == [(b, i, pytest.approx(r)) for b, i, r in want]
    assert len(want) > 30 and want[-1][0] == 10_000


def test_stream_heatmap_equals_batch_in_every_bucket(spark, rows, folder, unordered_files):
    log = folder("log")
    stream = one_by_one(spark, unordered_files)
    streaming.follow_heatmap(stream, log, folder("checkpoint"), [2, 5], by="metric").awaitTermination()
    names = ["bucket", "metric", "le", "observations", "rate"]
    batch = metrics.heatmap(spark.read.parquet(unordered_files), [2, 5], by="metric")
    assert rows(streaming.read_heatmap(spark, log, by="metric"), *names) == rows(batch, *names)


@pytest.mark.parametrize("cumulative", [False, True])
def test_heatmap_in_append_mode_equals_batch_in_closed_buckets(spark, rows, folder, sample_files, cumulative):
    stream = one_by_one(spark, sample_files)
    live = metrics.heatmap(
        stream.withWatermark("ts", "10 minutes"), [2, 5], by="metric", cumulative=cumulative
    )
    batch = metrics.heatmap(spark.read.parquet(sample_files), [2, 5], by="metric", cumulative=cumulative)
    assert rows(run_to_table(spark, live, folder)) == rows(batch.filter("bucket < 9000"))


def test_stream_count_rate_equals_batch(spark, rows, folder, sample_files):
    stream = spark.readStream.schema(SAMPLE).option("maxFilesPerTrigger", 1).parquet(sample_files)
    live = metrics.count_rate(stream.withWatermark("ts", "10 minutes"))
    batch = metrics.count_rate(spark.read.parquet(sample_files))
    assert rows(run_to_table(spark, live, folder)) == rows(batch.filter("bucket < 9000"))


def test_latest_state_as_a_stream_equals_batch(spark, rows, folder, sample_files):
    def changes(df):
        return df.select(F.col("instance").alias("account"), F.col("sample_id").alias("seqno"), "value")

    log, checkpoint = folder("log"), folder("checkpoint")
    stream = spark.readStream.schema(SAMPLE).option("maxFilesPerTrigger", 1).parquet(sample_files)
    streaming.follow_state(changes(stream), log, checkpoint, compact_every=2).awaitTermination()
    assert spark.read.parquet(f"{log}/log").select("batch_id").distinct().count() == 5
    assert rows(spark.read.parquet(f"{log}/snapshots")) == [(1,), (3,)]
    batch = state.latest_state(changes(spark.read.parquet(sample_files)))
    latest = streaming.read_state(spark, log)
    assert rows(latest, *batch.columns) == rows(batch)
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "snapshot-3" in plan and "batch_id" in plan


def test_latest_state_in_update_mode(spark, folder, sample_files, rows):
    stream = spark.readStream.schema(SAMPLE).option("maxFilesPerTrigger", 2).parquet(sample_files)
    latest = state.latest_state(
        stream.select(F.col("instance").alias("account"), F.col("sample_id").alias("seqno"))
    )
    seen = []
    latest.writeStream.outputMode("update").option("checkpointLocation", folder("checkpoint")).trigger(
        availableNow=True
    ).foreachBatch(lambda df, n: seen.extend(tuple(r) for r in df.collect())).start().awaitTermination()
    assert max(s for a, s in seen if a == 0) == 999


def test_backlog_first_then_arrivals(spark, rows, folder):
    path, out, checkpoint = folder("in"), folder("out"), folder("checkpoint")
    schema = spark.range(1).schema

    def run():
        sources.snapshot_then_follow(
            spark, path, schema, lambda df, n: sinks.append_batch(df, out, n), checkpoint
        ).awaitTermination()
        return rows(spark.read.parquet(out), "id")

    add_file(spark.range(3), path)
    add_file(spark.range(3, 5), path)
    assert run() == [(0,), (1,), (2,), (3,), (4,)]
    assert run() == [(0,), (1,), (2,), (3,), (4,)]  # nothing is taken twice
    add_file(spark.range(5, 6), path)
    assert run()[-1] == (5,)


def test_an_error_ends_the_run_and_the_batch_is_repeated(spark, rows, folder):
    path, out, checkpoint = folder("in"), folder("out"), folder("checkpoint")
    add_file(spark.range(3), path)
    schema = spark.range(1).schema

    def failing(df, n):
        sinks.append_batch(df, out, n)
        raise RuntimeError("sink is away")

    with pytest.raises(Exception, match="sink is away"):
        sources.snapshot_then_follow(spark, path, schema, failing, checkpoint).awaitTermination()
    sources.snapshot_then_follow(
        spark, path, schema, lambda df, n: sinks.append_batch(df, out, n), checkpoint
    ).awaitTermination()
    assert rows(spark.read.parquet(out), "id") == [(0,), (1,), (2,)]


def test_publish_stream_equals_batch(spark, rows, folder):
    path, out = folder("blocks"), folder("records")
    a, b = b"\x10" * 32, b"\xf0" * 32
    for n in range(3):
        data = [(-1 if n == 0 else 0, 0, n, [(a, [(1, n, b"p%d" % n)]), (b, [(2, n, b"q")])])]
        add_file(spark.createDataFrame(data, BLOCK), path)
    stream = sources.read_blocks(spark, path, stream=True, max_files_per_trigger=1)
    streaming.publish_stream(
        stream,
        [lambda df, n: sinks.append_batch(df, out, n)],
        folder("checkpoint"),
        pack=False,
    ).awaitTermination()
    names = ["key", "value", "partition", "event_ms"]
    batch = blocks.to_sink_record(blocks.flatten_transactions(sources.read_blocks(spark, path)))
    assert rows(spark.read.parquet(out), *names) == rows(batch, *names)
    assert sorted(r.partition for r in batch.collect()) == [0, 0, 1, 1, 8, 8]


def test_skip_existing_on_a_stream(spark, rows, folder):
    from chainlake import catalog

    path = folder("in")
    add_file(spark.range(4).withColumnRenamed("id", "object_id"), path)
    manifest = spark.createDataFrame([(2, None)], "object_id long, e_tag string")
    stream = spark.readStream.schema("object_id long").parquet(path)
    got = run_to_table(spark, catalog.skip_existing(stream, manifest), folder)
    assert rows(got) == [(0,), (1,), (3,)]


def test_packed_stream(spark, folder):
    path = folder("in")
    df = spark.createDataFrame([(b"x" * 99,)], "payload binary")
    add_file(df, path)
    stream = spark.readStream.schema(df.schema).parquet(path)
    row = run_to_table(spark, blocks.pack_payload(stream), folder).first()
    assert row.raw_size == 99 and row.packed_size < 99


def test_streams_need_a_checkpoint(spark, sample_files):
    stream = spark.readStream.schema(SAMPLE).parquet(sample_files)
    with pytest.raises(ValueError):
        sinks.fan_out(stream, [])
    records = stream.selectExpr(
        "encode(metric, 'utf-8') AS key", "encode(metric, 'utf-8') AS value", "0 AS partition", "1L AS event_ms"
    )
    with pytest.raises(ValueError):
        sinks.kafka(records, {"topic": "t", "brokers": "b", "group_id": "g"})
