import zstandard
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chainlake import blocks
from chainlake.plans import flows
from chainlake.schemas import BLOCK

A, B = bytes(32), b"\xff" + bytes(31)


def block(seqno, accounts, workchain=0, shard=0):
    return (workchain, shard, seqno, accounts)


def frame(spark, data):
    return spark.createDataFrame(data, BLOCK)


def test_flatten_keeps_order_and_repeated_accounts(spark):
    df = frame(
        spark,
        [block(7, [(A, [(1, 10, b"x"), (2, 11, b"y")]), (B, [(3, 12, b"z")]), (A, [(4, 13, b"w")])])],
    )
    got = [(bytes(r.addr), r.lt, r.now, bytes(r.payload)) for r in blocks.flatten_transactions(df).collect()]
    assert got == [(A, 1, 10, b"x"), (A, 2, 11, b"y"), (B, 3, 12, b"z"), (A, 4, 13, b"w")]


def test_empty_blocks_give_no_rows(spark):
    df = frame(spark, [block(1, []), block(2, None), block(3, [(A, [])])])
    assert blocks.flatten_transactions(df).count() == 0
    assert blocks.flatten_transactions(df.filter("seqno <> 3"), validate=True).count() == 0


@pytest.mark.parametrize(
    "accounts",
    [
        [(None, [(1, 1, b"x")])],
        [(A, None)],
        [(A, [(1, 1, b"x")]), (B, [(1, 1, None)])],
        [(A, [(1, None, b"x")])],
    ],
)
def test_unreadable_item_fails_the_block(spark, accounts):
    flat = blocks.flatten_transactions(frame(spark, [block(5, accounts)]), validate=True)
    with pytest.raises(Exception, match="unreadable item in block 0:0:5"):
        flat.count()


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.integers(0, 3), st.binary(min_size=32, max_size=32), st.integers(0, 2**32 - 1),
            st.binary(max_size=20),
        ),
        max_size=30,
    )
)
def test_flatten_undoes_nesting(spark, data):
    plain = spark.createDataFrame(
        [(0, 0, s, bytes(a), i, t, bytes(p)) for i, (s, a, t, p) in enumerate(data)],
        "workchain int, shard long, seqno long, addr binary, lt long, now long, payload binary",
    )
    key = ["workchain", "shard", "seqno"]
    nested = (
        plain.groupBy(*key, "addr")
        .agg(F.collect_list(F.struct("lt", "now", "payload")).alias("transactions"))
        .groupBy(*key)
        .agg(F.collect_list(F.struct("addr", "transactions")).alias("account_blocks"))
    )
    flat = blocks.flatten_transactions(nested, validate=True)
    columns = plain.columns
    assert flat.select(columns).exceptAll(plain).count() == 0
    assert plain.exceptAll(flat.select(columns)).count() == 0


def test_masterchain_is_decided_by_the_block(spark, rows):
    df = frame(spark, [block(1, [(B, [(1, 1, b"x")])], workchain=-1), block(2, [(B, [(1, 1, b"x")])])])
    routed = blocks.route_partition(blocks.flatten_transactions(df))
    assert rows(routed, "seqno", "partition") == [(1, 0), (2, 8)]


@pytest.mark.parametrize("level", [1, 3, 9])
def test_pack_round_trip(spark, level):
    data = [(i, bytes([i % 7]) * (i * 50)) for i in range(40)]
    df = spark.createDataFrame(data, "id int, payload binary")
    before = df.schema.simpleString()
    packed = blocks.unpack_payload(blocks.pack_payload(df, level)).collect()
    assert df.schema.simpleString() == before
    for row in packed:
        raw = bytes(row.payload)
        assert (row.raw_size, row.packed_size) == (len(raw), len(row.packed))
        assert zstandard.ZstdDecompressor().decompress(bytes(row.packed)) == raw
        assert bytes(row.unpacked) == raw


def test_packing_sends_the_payload_alone_to_python(spark):
    df = spark.range(3).selectExpr("id", "encode('x', 'utf-8') AS payload")
    plan = blocks.pack_payload(df)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInArrow" not in plan


@pytest.mark.parametrize("address", [b"", b"x" * 31])
def test_an_address_of_another_length_fails_its_block(spark, address):
    df = frame(spark, [block(1, [(address, [(1, 1700000000, b"hello")])])])
    with pytest.raises(Exception, match="unreadable item"):
        flows.publish(df, pack=False).collect()


def test_pack_fails_on_a_missing_payload(spark):
    df = spark.createDataFrame([(1, None)], "id int, payload binary")
    with pytest.raises(Exception):
        blocks.pack_payload(df).collect()


def test_publish_keys_hash_the_unpacked_payload(spark):
    df = frame(spark, [block(1, [(A, [(1, 1700000000, b"hello")])])])
    plain = flows.publish(df, pack=False).first()
    packed = flows.publish(df).first()
    assert bytes(plain.key) == bytes(packed.key)
    assert bytes(plain.value) == b"hello"
    assert zstandard.ZstdDecompressor().decompress(bytes(packed.value)) == b"hello"
    assert (plain.partition, plain.event_ms) == (1, 1700000000000)


def test_bundle_closes_all_but_the_newest(spark, rows):
    df = spark.createDataFrame([(s, 10) for s in (1, 2, 9, 10, 11, 25)], "seqno long, bytes long")
    catalog = blocks.archive_catalog(blocks.bundle(df, 10), "bytes")
    assert rows(catalog, "archive_id", "blocks", "closed", "size") == [
        (0, 3, True, 30),
        (10, 2, True, 20),
        (20, 1, False, None),
    ]
    plan = blocks.bundle(df, 10)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    with pytest.raises(ValueError):
        blocks.bundle(df, 0)
