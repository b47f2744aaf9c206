"""Records over a transport that fails, and sinks that fail while others don't."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chainlake import sinks
from chainlake.files import read_json
from chainlake.sinks.acknowledged import BATCH_BYTES, BATCH_RECORDS, FolderTransport, batches_of

SCHEMA = "workchain int, shard long, seqno long, key binary, value binary, partition int, event_ms long"


class FlakyTransport(FolderTransport):
    """Keeps some of what it is sent, acknowledges less, and breaks now and then."""

    def send(self, records):
        luck = random.Random(os.urandom(8))
        if luck.random() < 0.3:
            raise OSError("connection lost")
        arrived = [r for r in records if luck.random() < 0.8]
        if arrived:
            super().send(arrived)
        known = {id(r) for r in arrived}
        return [id(r) in known and luck.random() < 0.8 for r in records]


class DeadTransport(FolderTransport):
    def check(self, seconds):
        raise OSError(f"no answer in {seconds} s")


class ClosingTransport(FolderTransport):
    """Breaks a whole task, once for each folder: no sending again helps."""

    def send(self, records):
        if records[0]["key"] == b"bad":
            raise SystemExit("the worker died")
        return super().send(records)


def records(spark, n=500, partitions=4):
    return spark.range(n).select(
        F.lit(0).alias("workchain"), F.lit(1).cast("long").alias("shard"), F.floor(F.col("id") / 7).alias("seqno"),
        F.encode(F.col("id").cast("string"), "utf-8").alias("key"), F.encode(F.lit("v"), "utf-8").alias("value"),
        (F.col("id") % 9).cast("int").alias("partition"), (F.col("id") * 1000).alias("event_ms"),
    ).repartition(partitions)


def test_every_record_arrives_and_blocks_are_marked_after(spark, folder):
    marks, topic = folder("marks"), folder("topic")
    assert sinks.done_blocks(spark, marks).count() == 0
    sinks.acknowledged(records(spark), marks, f"tests.{__name__.rpartition(chr(46))[2]}:FlakyTransport", {"topic": topic}).save()
    got = spark.read.parquet(topic)
    assert {bytes(r.key) for r in got.collect()} == {str(i).encode() for i in range(500)}
    assert got.count() >= 500 and got.where("event_ms <> cast(cast(key as string) as long) * 1000").count() == 0
    done = {r.seqno: r.records for r in sinks.done_blocks(spark, marks).collect()}
    assert done == Counter(i // 7 for i in range(500))


def test_the_connection_is_checked_first(spark, folder):
    topic = folder("topic")
    with pytest.raises(Exception, match="no answer in 10 s"):
        sinks.acknowledged(records(spark), folder("marks"), f"tests.{__name__.rpartition(chr(46))[2]}:DeadTransport", {"topic": topic}).save()
    assert not os.path.exists(topic)


def test_a_lost_task_marks_nothing(spark, folder):
    marks, topic = folder("marks"), folder("topic")
    bad = records(spark, 40).withColumn("key", F.when(F.col("seqno") == 3, F.encode(F.lit("bad"), "utf-8")).otherwise(F.col("key")))
    with pytest.raises(Exception):
        sinks.acknowledged(bad.repartition(40), marks, f"tests.{__name__.rpartition(chr(46))[2]}:ClosingTransport", {"topic": topic}).save()
    assert sinks.done_blocks(spark, marks).count() == 0 and read_json(f"{marks}/done") == []


def test_streams_mark_each_batch_once(spark, folder):
    source, marks, topic, checkpoint = folder("in"), folder("marks"), folder("topic"), folder("check")
    for n in range(3):
        records(spark, 100, 1).withColumn("seqno", F.col("seqno") + 1000 * n).write.mode("append").parquet(source)
    for _ in range(2):
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        writer = sinks.acknowledged(stream, marks, f"tests.{__name__.rpartition(chr(46))[2]}:FlakyTransport", {"topic": topic}, checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
    assert len(read_json(f"{marks}/done")) == 3
    assert sinks.done_blocks(spark, marks).agg(F.sum("records")).first()[0] == 300


def test_batches_keep_the_fixed_bounds():
    rows = [((0, 0, i), {"key": b"k", "value": b"v" * (9_000_000 if i % 3 == 0 else 10)}) for i in range(30)]
    some = list(batches_of(iter(rows)))
    assert [r for batch in some for r in batch] == rows and len(some) == 5
    assert all(sum(len(r["value"]) for _, r in batch) <= BATCH_BYTES for batch in some)
    assert [len(b) for b in batches_of(((0, 0, 0), {"key": b"", "value": b""}) for _ in range(60_000))] == [BATCH_RECORDS, BATCH_RECORDS, 10_000]


def test_a_failing_sink_is_repeated_alone(spark, folder):
    source, checkpoint, progress = folder("in"), folder("check"), folder("progress")
    for n in range(3):
        spark.range(10 * n, 10 * n + 10).coalesce(1).write.mode("append").parquet(source)
    calls, broken = Counter(), [2]

    def sink(name):
        def write(batch, number):
            calls[name, number] += 1
            if name == "flaky" and number == 1 and broken[0]:
                broken[0] -= 1
                raise OSError("full")
            assert batch.count() == 10

        return write

    outputs = {name: sink(name) for name in ("first", "flaky", "last")}
    for attempt in range(3):
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source)
        query = sinks.fan_out(stream, outputs, checkpoint, progress=progress)
        if attempt < 2:
            with pytest.raises(Exception, match="not in these sinks yet: flaky"):
                query.awaitTermination()
        else:
            query.awaitTermination()
    assert calls == {**{(n, b): 1 for n in outputs for b in range(3)}, ("flaky", 1): 3}
