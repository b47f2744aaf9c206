import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chainlake import integrity, objects
from chainlake.functions import EMPTY_ETAG
from chainlake.plans import flows
from chainlake.schemas import CHUNK


def chunk_table(spark, contents, sizes):
    """Cut each object's bytes by a repeating list of chunk sizes."""
    data = []
    for object_id, content in contents.items():
        at = number = 0
        while at < len(content):
            size = sizes[number % len(sizes)]
            data.append((object_id, number, content[at : at + size]))
            at, number = at + size, number + 1
    return spark.createDataFrame(data, CHUNK)


def etag_of(content, part_size):
    parts = [content[i : i + part_size] for i in range(0, len(content), part_size)]
    return hashlib.md5(b"".join(hashlib.md5(p).digest() for p in parts)).hexdigest()


CONTENTS = {1: bytes(range(256)) * 20, 2: b"x" * 1024, 3: b"abc", 4: b"y" * 1025}


@pytest.mark.parametrize("sizes", [[700], [5000], [1024], [1, 3, 1500], [2048, 1]])
def test_parts_do_not_depend_on_the_chunks(spark, rows, sizes):
    parts = objects.rechunk(chunk_table(spark, CONTENTS, sizes), 1024)
    expected = sorted(
        (k, i // 1024, c[i : i + 1024]) for k, c in CONTENTS.items() for i in range(0, len(c), 1024)
    )
    assert rows(parts, "object_id", "part_no", "data") == expected


def test_single_byte_chunks(spark, rows):
    parts = objects.rechunk(chunk_table(spark, {1: b"hello world"}, [1]), 4)
    assert rows(parts) == [(1, 0, b"hell"), (1, 1, b"o wo"), (1, 2, b"rld")]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.dictionaries(st.integers(0, 5), st.binary(min_size=1, max_size=300), min_size=1, max_size=4),
    st.lists(st.integers(1, 90), min_size=1, max_size=4),
    st.integers(1, 120),
    st.integers(1, 5),
)
def test_any_chunking_any_part_size(spark, contents, sizes, part_size, span):
    chunks = chunk_table(spark, contents, sizes)
    parts = objects.rechunk(chunks, part_size, span=span)
    got = {(r.object_id, r.part_no): bytes(r.data) for r in parts.collect()}
    want = {
        (k, i // part_size): c[i : i + part_size]
        for k, c in contents.items()
        for i in range(0, len(c), part_size)
    }
    assert got == want


@pytest.mark.parametrize("span", [1, 2, 3, 4096])
def test_offsets_do_not_depend_on_the_span(spark, rows, span):
    chunks = chunk_table(spark, {1: b"a" * 100, 2: b"b" * 7}, [10, 3])
    offsets = rows(objects.chunk_offsets(chunks, span=span), "object_id", "chunk_no", "offset")
    assert offsets[:4] == [(1, 0, 0), (1, 1, 10), (1, 2, 13), (1, 3, 23)]
    assert offsets[-2:] == [(1, 14, 91), (2, 0, 0)]


def test_gaps_in_chunk_numbers_and_empty_chunks(spark, rows):
    chunks = spark.createDataFrame([(1, 5, b"ab"), (1, 9000, b""), (1, 9001, b"cd")], CHUNK)
    assert rows(objects.rechunk(chunks, 3)) == [(1, 0, b"abc"), (1, 1, b"d")]


def test_composite_key(spark, rows):
    key = ["workchain", "seqno", "kind"]
    chunks = spark.createDataFrame(
        [(-1, 1, "shard", 0, b"abcd"), (0, 1, "shard", 0, b"ef"), (0, 1, "queue", 0, b"gh")],
        "workchain int, seqno long, kind string, chunk_no long, data binary",
    )
    etags = flows.expected_etags(chunks, 3, key)
    assert rows(etags, *key, "parts", "size") == [
        (-1, 1, "shard", 2, 4),
        (0, 1, "queue", 1, 2),
        (0, 1, "shard", 1, 2),
    ]


def test_given_offsets_and_lengths_are_used(spark, rows):
    chunks = chunk_table(spark, {1: b"hello world"}, [4])
    with_offset = chunks.withColumn("offset", F.col("chunk_no") * 4)
    assert rows(objects.rechunk(with_offset, 5)) == rows(objects.rechunk(chunks, 5))
    plan = objects.rechunk(with_offset, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("shift", ["chunk_no * 5", "chunk_no * 3", "chunk_no * 4 + 1"])
def test_wrong_given_offsets_fail(spark, shift):
    chunks = chunk_table(spark, {1: b"hello world"}, [4]).withColumn("offset", F.expr(shift))
    with pytest.raises(Exception, match="gap or overlap in part 1:"):
        objects.rechunk(chunks, 100).collect()


def test_length_column_spares_the_bytes(spark, folder):
    path = folder("chunks")
    chunk_table(spark, CONTENTS, [700]).withColumn("length", F.octet_length("data")).write.parquet(path)
    offsets = objects.chunk_offsets(spark.read.parquet(path))
    scan = offsets._jdf.queryExecution().executedPlan().toString()
    assert "data:binary" not in scan


def test_stored_chunks_share_one_metadata_shuffle(spark, folder):
    path = folder("chunks")
    chunk_table(spark, CONTENTS, [700]).write.parquet(path)
    offsets = objects.chunk_offsets(spark.read.parquet(path))
    offsets.collect()
    assert "ReusedExchange" in offsets._jdf.queryExecution().executedPlan().toString()


def test_composite_etag_vectors(spark, rows):
    digests = spark.createDataFrame(
        [
            (1, 1, 1, hashlib.md5(b"b").hexdigest()),
            (1, 0, 1, hashlib.md5(b"a").hexdigest()),
        ],
        "object_id long, part_no long, length long, md5 string",
    )
    known = spark.createDataFrame([(1,), (2,)], "object_id long")
    assert rows(integrity.composite_etag(digests), "object_id", "etag", "parts", "size") == [
        (1, "96e024ba2074fe77e8e965ba43a704be", 2, 2)
    ]
    assert rows(integrity.composite_etag(digests, objects=known), "object_id", "etag", "parts") == [
        (1, "96e024ba2074fe77e8e965ba43a704be", 2),
        (2, EMPTY_ETAG, 0),
    ]


@pytest.mark.parametrize("fan_in", [1, 2, 3, 1024])
def test_etag_does_not_depend_on_the_fan_in(spark, rows, fan_in):
    parts = objects.rechunk(chunk_table(spark, CONTENTS, [700]), 500)
    etags = integrity.composite_etag(integrity.part_md5(parts), fan_in=fan_in)
    assert rows(etags, "object_id", "etag") == [
        (k, etag_of(c, 500)) for k, c in sorted(CONTENTS.items())
    ]


def test_one_part_differs_from_plain_md5(spark):
    etag = flows.expected_etags(chunk_table(spark, {1: b"abc"}, [2]), 10).first().etag
    assert etag != hashlib.md5(b"abc").hexdigest()
    assert etag == etag_of(b"abc", 10)


def test_part_size_must_be_positive(spark):
    with pytest.raises(ValueError):
        objects.rechunk(chunk_table(spark, {1: b"a"}, [1]), 0)


def placed(spark, *chunks):
    """Chunks of one object as (offset, length)."""
    data = [(1, n, at, b"x" * length) for n, (at, length) in enumerate(chunks)]
    return spark.createDataFrame(data, "object_id long, chunk_no long, offset long, data binary")


@pytest.mark.parametrize(
    "chunks, part_size",
    [
        ([(0, 6), (10, 10)], 10),  # a gap at the end of a part
        ([(0, 10), (20, 5)], 10),  # a part is missing
        ([(0, 8), (4, 8), (16, 4)], 20),  # gap and overlap of one size
        ([(2, 8)], 10),  # a gap at the begin
    ],
)
def test_gaps_and_overlaps_fail(spark, chunks, part_size):
    with pytest.raises(Exception, match="gap or overlap|missing or cut short"):
        flows.expected_etags(placed(spark, *chunks), part_size).collect()


def test_a_repeated_chunk_number_fails(spark):
    chunks = spark.createDataFrame([(1, 0, b"aa"), (1, 0, b"aa"), (1, 1, b"bb")], CHUNK)
    with pytest.raises(Exception, match="occurs twice"):
        objects.rechunk(chunks, 4).collect()


def test_the_check_of_given_offsets_needs_no_further_shuffle(spark):
    plan = objects.rechunk(placed(spark, (0, 5)), 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
