"""Registered queries: at least one per operator, over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import sinks, sources, streaming
from ..functions.keys import event_ms
from ..operators import blocks, catalog, integrity, metrics, objects, series, sketches, state
from ..operators.metrics import Matching
from ..schemas import CHUNK
from ..session import scratch_dir
from . import flows, views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Fixed values shared with the SQL checks.
DAY = "1 day"
DIGITS = 9  # more than the data can tie at
TAIL = 50
LOOKBACK = 3
SERIES_BUCKETS = 4
VALUE_BOUNDS = [1, 5, 10, 25, 50, 100, 250]
TIME_BOUNDS = [1, 2, 5, 9]
ZSTD_MAGIC = "28B52FFD"

#: Files in one micro-batch.
FILES_PER_BATCH = 64


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def hex_of(name: str) -> Column:
    return F.lower(F.hex(name)).alias(name)


def text_of(name: str) -> Column:
    return F.decode(name, "utf-8").alias(name)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, DIGITS) for name in names})


def stream_path(sf_dir: str, name: str) -> str:
    """Path of a test table for a stream.

    A stream wants a folder or a pattern; the pattern also fits a single file.
    """
    return f"{sf_dir}/{name}.parque[t]"


def streamed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as a stream."""
    schema = views.table(spark, sf_dir, name).schema
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES_PER_BATCH)
    return files.parquet(stream_path(sf_dir, name))


# --- Sources ----------------------------------------------------------------


@query
def block_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "blocks")
    views.blocks(spark, sf_dir).write.parquet(path)
    count = F.aggregate(
        F.transform("account_blocks", lambda a: F.size(a["transactions"])),
        F.lit(0),
        lambda total, n: total + n,
    )
    return sources.read_blocks(spark, path).select(
        "workchain",
        "shard",
        "seqno",
        F.size("account_blocks").cast("long").alias("accounts"),
        count.cast("long").alias("transactions"),
    )


@query
def merge_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.merge_sources(views.sources(spark, sf_dir), "seqno")


def _document_archives(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_dir(spark, "archives")
    documents = views.document_bytes(spark, sf_dir).drop("lang")
    span = F.lit(views.OBJECTS_PER_ARCHIVE).cast("long")
    archive_id = F.col("object_id") - F.pmod("object_id", span)
    sinks.archives(documents.withColumn("archive_id", archive_id), path)
    return path


@query
def archive_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _document_archives(spark, sf_dir)
    content = StructType([f for f in CHUNK.fields if f.name != "chunk_no"])
    return sources.read_archives(spark, path, schema=content).select(
        "archive_id", "object_id", F.md5("data").alias("md5")
    )


@query
def archive_replay_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "block-archives")
    span = views.BLOCKS_PER_ARCHIVE
    flows.store_blocks(views.blocks(spark, sf_dir, span), path, span, placed=True)
    latest = flows.replay(spark, path, order=["seqno", "lt", "payload"])
    return latest.select(
        hex_of("account"), "workchain", "seqno", "lt", "now", text_of("payload")
    )


@query
def archive_replay_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "block-archives")
    span = views.BLOCKS_PER_ARCHIVE
    flows.store_blocks(views.blocks(spark, sf_dir, span), path, span, placed=True)
    latest = streaming.follow_archives(
        spark,
        path,
        scratch_dir(spark, "state-log"),
        scratch_dir(spark, "checkpoint"),
        ["seqno", "lt", "payload"],
        max_files_per_trigger=FILES_PER_BATCH,
    )
    return latest.select(
        hex_of("account"), "workchain", "seqno", "lt", "now", text_of("payload")
    )


@query
def committed_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.committed_tail(views.catalog(spark, sf_dir), TAIL)


@query
def backlog_follow(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "followed")
    sources.snapshot_then_follow(
        spark,
        stream_path(sf_dir, "events"),
        views.table(spark, sf_dir, "events").schema,
        lambda batch, number: sinks.append_batch(batch, out, number),
        scratch_dir(spark, "checkpoint"),
    ).awaitTermination()
    return spark.read.parquet(out).select("event_id", "user_id", "event_type", "value")


@query
def chunk_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objects.chunk_offsets(views.chunks(spark, sf_dir))


# --- Records ----------------------------------------------------------------


@query
def flatten_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = blocks.flatten_transactions(views.blocks(spark, sf_dir), validate=True)
    return flat.select(
        "workchain", "shard", "seqno", hex_of("addr"), "lt", "now", text_of("payload")
    )


@query
def content_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.lines(spark, sf_dir).select(
        "seqno", "lt", F.lower(F.hex(blocks.content_key("payload"))).alias("key")
    )


@query
def route_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = blocks.route_partition(views.transactions(spark, sf_dir))
    return routed.select("workchain", "seqno", hex_of("addr"), "partition")


@query
def event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.lines(spark, sf_dir).select(
        "seqno",
        "lt",
        event_ms("now").alias("event_ms"),
        F.unix_micros(blocks.event_time("now")).alias("event_us"),
    )


@query
def pack_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.lines(spark, sf_dir).select("lt", "payload")
    whole = F.sha2("unpacked", 256) == F.sha2("payload", 256)
    frame = F.hex(F.substring("packed", 1, 4)) == ZSTD_MAGIC
    return (
        blocks.unpack_payload(blocks.pack_payload(lines))
        .groupBy("lt")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.sum("raw_size").alias("raw_bytes"),
            F.count_if(frame & whole).alias("frames"),
        )
    )


@query
def sink_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = flows.publish(views.blocks(spark, sf_dir), pack=False)
    return records.select(hex_of("key"), text_of("value"), "partition", "event_ms")


@query
def kafka_record_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = blocks.to_sink_record(
        blocks.flatten_transactions(views.blocks(spark, sf_dir))
    )
    return (
        sinks.kafka_columns(records)
        .groupBy("partition")
        .agg(F.count(F.lit(1)).alias("records"))
    )


@query
def publish_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, out = scratch_dir(spark, "blocks"), scratch_dir(spark, "records")
    views.blocks(spark, sf_dir).write.parquet(path)
    stream = sources.read_blocks(spark, path, stream=True, max_files_per_trigger=1000)
    streaming.publish_stream(
        stream,
        [lambda batch, number: sinks.append_batch(batch, out, number)],
        scratch_dir(spark, "checkpoint"),
    ).awaitTermination()
    return (
        spark.read.parquet(out)
        .groupBy("partition")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.countDistinct("key").alias("keys"),
            F.max("event_ms").alias("last_event_ms"),
        )
    )


@query
def noop_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = flows.publish(views.blocks(spark, sf_dir))
    return spark.range(1).select(F.lit(sinks.noop_count(records)).cast("long").alias("records"))


@query
def bundle_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = views.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seqno"), F.floor("o_totalprice").alias("bytes")
    )
    bundled = blocks.bundle(orders, views.BLOCKS_PER_ARCHIVE)
    return blocks.archive_catalog(bundled, "bytes")


# --- Objects ----------------------------------------------------------------


@query
def rechunk_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = objects.rechunk(views.chunks(spark, sf_dir), views.PART_SIZE)
    return parts.select(
        "object_id",
        "part_no",
        F.octet_length("data").cast("long").alias("length"),
        F.sha2("data", 256).alias("sha256"),
    )


@query
def rechunk_at_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = views.chunks(spark, sf_dir).withColumn(
        "offset", F.col("chunk_no") * views.CHUNK_SIZE
    )
    return integrity.part_md5(objects.rechunk(placed, views.PART_SIZE))


@query
def part_md5(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = objects.rechunk(views.chunks(spark, sf_dir), views.PART_SIZE)
    return integrity.part_md5(parts)


@query
def composite_etag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.expected_etags(views.chunks(spark, sf_dir), views.PART_SIZE)


@query
def verify_etag(spark: SparkSession, sf_dir: str) -> DataFrame:
    etags = flows.expected_etags(views.chunks(spark, sf_dir), views.PART_SIZE)
    checked = integrity.verify(etags, views.manifest(spark, sf_dir))
    return checked.select("object_id", "etag", "present", "verified")


@query
def skip_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.skip_existing(
        views.catalog(spark, sf_dir), views.manifest(spark, sf_dir)
    )


@query
def skip_existing_unchecked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store's answer failed for every third object, which so counts as absent."""
    return catalog.skip_existing(
        views.catalog(spark, sf_dir),
        views.manifest(spark, sf_dir),
        check_failed=F.col("object_id") % 3 == 0,
    )


@query
def pending_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    committed = views.catalog(spark, sf_dir).filter(F.col("size").isNotNull())
    # Only the bytes of committed objects are cut and digested.
    chunks = views.chunks(spark, sf_dir).join(committed, "object_id", "left_semi")
    etags = flows.expected_etags(chunks, views.PART_SIZE)
    expected = committed.join(etags.drop("size"), "object_id")
    return integrity.pending(expected, views.manifest(spark, sf_dir))


@query
def ship_until_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.ship(
        spark,
        views.catalog(spark, sf_dir),
        views.chunks(spark, sf_dir),
        views.manifest(spark, sf_dir),
        scratch_dir(spark, "store"),
        views.PART_SIZE,
    )


@query
def ship_committed_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.ship_committed_tail(
        spark,
        views.catalog(spark, sf_dir),
        views.chunks(spark, sf_dir),
        views.manifest(spark, sf_dir),
        scratch_dir(spark, "store"),
        views.PART_SIZE,
        {"last_archives_to_upload": TAIL},
    )


@query
def object_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files, read back by ranges of bytes and cut into parts."""
    out = scratch_dir(spark, "objects")
    whole = views.document_bytes(spark, sf_dir).select("object_id", F.lit(0).alias("part_no"), "data")
    sinks.parts(whole, out)
    ranges = sources.read_objects(spark, f"{out}/staged", views.CHUNK_SIZE, id_pattern=r"^(\d+)-")
    return integrity.part_md5(objects.rechunk(ranges, views.PART_SIZE))


@query
def object_parts_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags of objects as the store reported them for their parts."""
    out = scratch_dir(spark, "parts")
    sinks.parts(objects.rechunk(views.chunks(spark, sf_dir), views.PART_SIZE * 64), out)
    stored = sinks.read_parts(sinks.committed_parts(spark, out)).withColumnRenamed("part_no", "chunk_no")
    return flows.expected_etags(stored, views.PART_SIZE)


@query
def acknowledged_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks all of whose records were acknowledged, and how many of them the topic holds."""
    marks, topic = scratch_dir(spark, "marks"), scratch_dir(spark, "topic")
    flat = blocks.flatten_transactions(views.blocks(spark, sf_dir))
    records = blocks.route_partition(flat).select(
        "workchain", "shard", "seqno", blocks.content_key("payload").alias("key"),
        F.col("payload").alias("value"), "partition", event_ms("now").alias("event_ms"),
    )
    sinks.acknowledged(records, marks, "chainlake.sinks.acknowledged:FolderTransport", {"topic": topic}).save()
    sent = spark.read.parquet(topic).groupBy("partition").agg(F.count(F.lit(1)).alias("sent"), F.max("event_ms").alias("last_event_ms"))
    done = sinks.done_blocks(spark, marks)
    blocks_done, acknowledged = done.agg(F.count(F.lit(1))), done.agg(F.sum("records"))
    return sent.withColumns({"blocks": blocks_done.scalar(), "acknowledged": acknowledged.scalar()})


@query
def archive_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _document_archives(spark, sf_dir)
    return (
        spark.read.parquet(path)
        .groupBy(F.col("archive_id").cast("long").alias("archive_id"))
        .agg(
            F.count(F.lit(1)).alias("objects"),
            F.sum(F.octet_length("data")).alias("bytes"),
            F.min("object_id").alias("first_object"),
            F.max("object_id").alias("last_object"),
        )
    )


@query
def shipping_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.shipping_summary(views.ship_log(spark, sf_dir))


@query
def shipping_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(catalog.shipping_sizes(views.ship_log(spark, sf_dir)), "value")


@query
def shipping_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = catalog.shipping_times(views.ship_log(spark, sf_dir), TIME_BOUNDS, "1 week")
    return rounded(times, "rate")


# --- State ------------------------------------------------------------------


@query
def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.latest_state(views.accounts(spark, sf_dir))


@query
def stream_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "state-log")
    changes = views.as_accounts(streamed(spark, sf_dir, "events"))
    streaming.follow_state(changes, out, scratch_dir(spark, "checkpoint")).awaitTermination()
    return streaming.read_state(spark, out)


@query
def state_store_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest state of each account, read from the state store itself."""
    checkpoint = scratch_dir(spark, "checkpoint")
    changes = views.as_accounts(streamed(spark, sf_dir, "events"))
    streaming.follow_state_store(changes, checkpoint).awaitTermination()
    return streaming.read_state_store(spark, checkpoint)


@query
def stream_closed_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of a stream of blocks, emitted as they close."""
    out = scratch_dir(spark, "closed")
    stream = streamed(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("seqno"), F.floor("o_totalprice").alias("bytes"))
    streaming.follow_closed_archives(
        stream, out, scratch_dir(spark, "checkpoint"), views.BLOCKS_PER_ARCHIVE, "bytes"
    ).awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


@query
def stream_merge_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streams of blocks in order of priority: what was taken and what still waits."""
    out, checkpoint = scratch_dir(spark, "merged"), scratch_dir(spark, "checkpoint")
    streams = views.source_rows(streamed(spark, sf_dir, "orders"))
    streaming.follow_merged(streams, out, checkpoint, time="at", wait="1 day").awaitTermination()
    taken = spark.read.parquet(out).select("seqno", "priority", "payload")
    return taken.unionByName(streaming.read_waiting(spark, checkpoint).select("seqno", "priority", "payload"))


@query
def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "snapshots")
    latest = state.latest_state(views.accounts(spark, sf_dir)).withColumnRenamed(
        "seqno", "last_seqno"
    )
    keys = [{"workchain": w, "seqno": 1, "kind": "accounts"} for w in (-1, 0)]
    sinks.snapshots([(key, latest) for key in keys], out)
    return spark.read.parquet(out).select(
        F.col("workchain").cast("long").alias("workchain"),
        F.col("seqno").cast("long").alias("seqno"),
        "kind",
        "account",
        "last_seqno",
        "value",
    )


@query
def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, counts = scratch_dir(spark, "fan-rows"), scratch_dir(spark, "fan-counts")
    per_type = lambda df: df.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.max("event_id").alias("last_event")
    )
    sinks.fan_out(
        streamed(spark, sf_dir, "events"),
        [
            lambda batch, number: sinks.append_batch(batch, rows, number),
            lambda batch, number: sinks.append_batch(per_type(batch), counts, number),
        ],
        scratch_dir(spark, "checkpoint"),
    ).awaitTermination()
    from_rows = per_type(spark.read.parquet(rows)).withColumn("output", F.lit("rows"))
    from_counts = (
        spark.read.parquet(counts)
        .groupBy("event_type")
        .agg(F.sum("events").alias("events"), F.max("last_event").alias("last_event"))
        .withColumn("output", F.lit("counts"))
    )
    return from_rows.unionByName(from_counts)


# --- Metrics ----------------------------------------------------------------


@query
def label_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    matchers = {"job": [0, 2], "kind": Matching("[1-4][0-9]"), "instance": Matching(".*")}
    chosen = metrics.select_series(
        views.samples(spark, sf_dir), ["click", "purchase"], matchers
    )
    return chosen.select("sample_id", "metric", "instance", "job", "kind", "value")


@query
def sum_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = metrics.select_series(views.samples(spark, sf_dir), "click")
    rates = metrics.sum_rate(clicks, bucket=DAY, tie="sample_id")
    return rounded(rates, "rate")


@query
def sum_increase(spark: SparkSession, sf_dir: str) -> DataFrame:
    grown = metrics.sum_increase(
        views.samples(spark, sf_dir), ["metric", "job"], DAY, tie="sample_id"
    )
    return rounded(grown, "increase")


@query
def stream_sum_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "rates")
    samples = views.as_samples(streamed(spark, sf_dir, "events"))
    streaming.follow_samples(
        samples, out, scratch_dir(spark, "checkpoint"), tie="sample_id"
    ).awaitTermination()
    rates = streaming.read_rate(spark, out, ["metric", "job"], DAY, tie="sample_id")
    return rounded(rates, "rate")


def _rates_in_state(spark: SparkSession, sf_dir: str) -> str:
    out = scratch_dir(spark, "rates")
    samples = views.as_samples(streamed(spark, sf_dir, "events"))
    streaming.follow_rates(
        samples, out, scratch_dir(spark, "checkpoint"), DAY, tie="sample_id"
    ).awaitTermination()
    return out


@query
def state_sum_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _rates_in_state(spark, sf_dir)
    return rounded(streaming.read_rates(spark, out, ["metric", "job"], DAY), "rate")


@query
def state_percent_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _rates_in_state(spark, sf_dir)
    return rounded(streaming.read_percent(spark, out, "click", "view"), "percent")


@query
def stream_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "heatmap")
    samples = views.as_samples(streamed(spark, sf_dir, "events"))
    streaming.follow_heatmap(
        samples, out, scratch_dir(spark, "checkpoint"), VALUE_BOUNDS, DAY, "metric"
    ).awaitTermination()
    return rounded(streaming.read_heatmap(spark, out, DAY, "metric"), "rate")


@query
def summary_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order priorities stand for the quantiles that a summary keeps."""
    stored = views.samples(spark, sf_dir).withColumn(
        "quantile", F.element_at(F.array(*map(F.lit, metrics.ACCEPTED_QUANTILES)), (F.col("kind") % 7 + 1).cast("int"))
    )
    chosen = metrics.summary_quantile(stored, "click", "0.95")
    return chosen.select("sample_id", "instance", "job", "value")


@query
def stored_count_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate of the counter ``<metric>_count`` that a histogram keeps."""
    stored = views.samples(spark, sf_dir).withColumn("metric", F.concat("metric", F.lit("_count")))
    counts = metrics.select_series(stored, "view_count")
    return rounded(metrics.sum_rate(counts, "job", DAY, tie="sample_id"), "rate")


@query
def percent_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratio = metrics.percent_ratio(
        views.samples(spark, sf_dir), "click", "view", bucket=DAY, tie="sample_id"
    )
    return rounded(ratio, "percent")


@query
def hit_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rate = metrics.hit_rate(
        views.samples(spark, sf_dir), "error", "view", bucket=DAY, tie="sample_id"
    )
    return rounded(rate, "hit_rate")


@query
def vector_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = views.samples(spark, sf_dir)
    lag = metrics.binary_op(
        metrics.select_series(samples, "click"),
        metrics.select_series(samples, "view"),
        "-",
        bucket=DAY,
        tie="sample_id",
    )
    return rounded(lag, "value")


@query
def vector_match_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = views.samples(spark, sf_dir)
    lag = metrics.binary_op(
        metrics.select_series(samples, "click"),
        metrics.select_series(samples, "view"),
        "-",
        bucket=DAY,
        tie="sample_id",
        lookback=LOOKBACK,
    )
    return rounded(lag, "value")


@query
def latest_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = metrics.latest(views.samples(spark, sf_dir), tie="sample_id")
    return latest.select(
        "metric", "instance", "job", F.unix_micros("ts").alias("ts_us"), "value"
    )


@query
def agg_across_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = metrics.latest(views.samples(spark, sf_dir), tie="sample_id")
    every = metrics.aggregate(latest, list(metrics.AGGREGATES), ["metric", "job"])
    return rounded(every, "avg", "sum")


@query
def agg_global_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = metrics.select_series(views.samples(spark, sf_dir), "click")
    return metrics.aggregate(metrics.latest(clicks, tie="sample_id"), "min")


@query
def heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = metrics.heatmap(
        views.samples(spark, sf_dir), VALUE_BOUNDS, metrics.RATE_INTERVAL, by="metric"
    )
    return rounded(cells, "rate")


@query
def heatmap_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = metrics.heatmap(
        views.samples(spark, sf_dir), VALUE_BOUNDS, DAY, cumulative=True
    )
    return rounded(cells, "rate")


@query
def bucket_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    counters = views.samples(spark, sf_dir).withColumns(
        {
            "metric": F.concat("metric", F.lit("_bucket")),
            "le": (F.col("kind") - F.col("kind") % 25).cast("double"),
        }
    )
    rates = metrics.bucket_heatmap(counters, "view", DAY, tie="sample_id")
    return rounded(rates, "rate")


@query
def quantile_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = metrics.quantile(views.samples(spark, sf_dir), "0.95", by="metric")
    return rounded(values, "value")


@query
def quantile_by_instance(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = metrics.quantile(views.samples(spark, sf_dir), "0.999")
    return rounded(values, "value")


@query
def quantile_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.quantile(views.samples(spark, sf_dir), "0.5", by=()), "value")


@query
def quantile_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each sketched value's rank is within the accuracy that the sketch states."""
    samples = views.samples(spark, sf_dir).filter(F.col("value").isNotNull())
    sketched = metrics.quantile(samples, "0.95", exact=False).withColumnRenamed("value", "found")
    below, upto, rank = F.count_if(F.col("value") < F.col("found")), F.count_if(F.col("value") <= F.col("found")), 0.95 * F.count(F.lit(1))
    error = F.count(F.lit(1)) / metrics.SKETCH_ACCURACY + 1
    ranks = samples.join(sketched, "instance").groupBy("instance")
    return ranks.agg(((below - error <= rank) & (rank <= upto + error)).alias("within"))


@query
def quantile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether quantiles of merged sketches have a rank within the stated bound."""
    samples = views.samples(spark, sf_dir).filter(F.col("value").isNotNull())
    daily = sketches.merge(sketches.sketch(samples, DAY), ["bucket", "metric", "job"])
    found = sketches.quantile(daily, "0.9", "metric").withColumnRenamed("value", "found")
    total = F.count(F.lit(1))
    error, rank = 3 * sketches.rank_error() * total + 1, 0.9 * total
    below, upto = F.count_if(F.col("value") < F.col("found")), F.count_if(F.col("value") <= F.col("found"))
    ranks = samples.join(found, "metric").groupBy("metric")
    return ranks.agg(total.alias("samples"), ((below - error <= rank) & (rank <= upto + error)).alias("within"))


def _indexed(spark: SparkSession, sf_dir: str) -> str:
    """Samples and their index, in two batches."""
    out = scratch_dir(spark, "series")
    samples = views.samples(spark, sf_dir)
    for batch in range(2):
        series.add_samples(samples.filter(F.pmod("sample_id", F.lit(2)) == batch), out, batch, buckets=SERIES_BUCKETS)
    return out


@query
def indexed_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    matchers = {"job": [0, 2], "kind": Matching("[1-4][0-9]"), "instance": Matching(".*")}
    chosen = series.select_indexed(spark, _indexed(spark, sf_dir), ["click", "purchase"], matchers)
    return chosen.select("sample_id", "metric", "instance", "job", "kind", "value")


@query
def indexed_label_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.indexed_label_values(spark, _indexed(spark, sf_dir), "click", "kind")


@query
def count_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = views.samples(spark, sf_dir)
    return rounded(metrics.count_rate(samples, ["metric", "job"], DAY), "rate")


@query
def label_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.label_values(views.samples(spark, sf_dir), "click", "kind")
