"""Merged sources whose state lies in tables: whole batches and not single keys."""

import pytest

from chainlake import streaming
from chainlake.sources import merge_sources
from chainlake.streaming import merge

SCHEMA = "seqno long, ts timestamp, payload string"


@pytest.fixture
def sources(spark, folder):
    """Three sources as folders and a way to add one file to each."""
    folders = [folder(f"in{p}") for p in range(3)]

    def put(rows_of):
        for p, path in enumerate(folders):
            own = [(k, t, text) for q, k, t, text in rows_of if q == p]
            df = spark.createDataFrame(own, "seqno long, at long, payload string")
            df.selectExpr("seqno", "timestamp_seconds(at) AS ts", "payload").coalesce(1).write.mode("append").parquet(path)

    def streams(files=1):
        return [spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files).parquet(f) for f in folders]

    return put, streams, folders


def test_no_key_is_handled_alone(spark, folder, rows, sources):
    """Spark's store holds no row per key, and rows are those of the batch merge."""
    _, streams, folders = sources
    out, checkpoint, keys = folder("out"), folder("check"), 60_000
    for p, path in enumerate(folders):
        own = spark.range(keys).filter(f"id % {3 - p} = 0").selectExpr("id AS seqno", "timestamp_seconds(id) AS ts", f"concat('{p}:', id) AS payload")
        own.write.parquet(path)
    query = streaming.follow_merged(streams(1000), out, checkpoint, wait=keys // 2)
    query.awaitTermination()
    assert all(o["numRowsTotal"] == 0 for p in query.recentProgress for o in p["stateOperators"])
    every = merge_sources([spark.read.schema(SCHEMA).parquet(f) for f in folders])
    taken, waiting = spark.read.parquet(out), streaming.read_waiting(spark, checkpoint)
    names = ["seqno", "priority", "payload"]
    # key 0 is at the watermark where it begins, so that it is late
    assert rows(taken.select(*names).unionByName(waiting.select(*names))) == rows(every.filter("seqno > 0"), *names)
    assert waiting.filter(f"seqno < {keys // 2 - 1}").isEmpty() and not waiting.isEmpty()


@pytest.mark.parametrize("restarts", [False, True])
def test_batches_take_hold_and_forget(spark, folder, rows, sources, monkeypatch, restarts):
    monkeypatch.setattr(merge, "COMPACT_EVERY", 2)
    put, streams, _ = sources
    out, checkpoint = folder("out"), folder("check")

    def go():
        streaming.follow_merged(streams(), out, checkpoint, wait=10, remember=20).awaitTermination()

    batches = [
        [(2, 1, 100, "a2"), (2, 5, 100, "a5"), (0, 2, 200, "b"), (0, 2, 200, "b again"), (1, None, 150, "no key")],
        [(0, 1, 150, "a0"), (1, 5, 300, "c5"), (0, 3, 250, "q"), (2, None, 150, "no key"), (0, 4, None, "no time")],
        [(0, 5, 205, "known"), (0, 6, 200, "late"), (0, 7, 201, "in time"), (1, 1, 260, "known")],
        [(0, 8, 1000, "end"), (2, 8, 1000, "known")],
        [(1, 1, 1001, "later"), (0, 5, 1001, "forgotten"), (2, 3, 1002, "known")],
    ]
    for batch in batches:
        put(batch)
        if restarts:
            go()
    if not restarts:
        go()
    common = [(2, 0, "b"), (2, 0, "b again"), (3, 0, "q"), (4, 0, "no time"), (5, 0, "forgotten"), (8, 0, "end"), (None, 1, "no key")]
    if restarts:  # a batch without rows follows each, at the end of which the limit has passed
        want = [(1, 2, "a2"), (5, 2, "a5")]
    else:
        want = [(1, 0, "a0"), (5, 1, "c5"), (7, 0, "in time")]
    waits = [(1, 1, "later")] if restarts else []
    names = ["seqno", "priority", "payload"]
    taken = spark.read.parquet(out)
    assert rows(taken, *names) == sorted([*common, *want], key=lambda r: tuple((v is None, v) for v in r))
    assert rows(streaming.read_waiting(spark, checkpoint), *names) == waits
    done = taken.count()
    go()
    assert spark.read.parquet(out).count() == done
