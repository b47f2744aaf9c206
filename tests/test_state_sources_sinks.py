import pytest
from pyspark.sql import functions as F

from chainlake import sinks, sources, state
from chainlake.plans import flows
from chainlake.schemas import BLOCK, CHUNK


def test_latest_state(spark, rows):
    df = spark.createDataFrame(
        [(1, 5, "a"), (1, 7, None), (2, 1, "c"), (1, 6, "b")], "account long, seqno long, v string"
    )
    assert rows(state.latest_state(df)) == [(1, 7, None), (2, 1, "c")]


def test_latest_state_by_two_columns(spark, rows):
    df = spark.createDataFrame(
        [(1, 5, 2, "b"), (1, 5, 9, "c"), (1, 4, 10, "a")], "account long, seqno long, lt long, v string"
    )
    assert rows(state.latest_state(df, order=["seqno", "lt"])) == [(1, 5, 9, "c")]


def test_merge_takes_the_first_source(spark, rows):
    def source(data):
        return spark.createDataFrame(data, "seqno long, payload string")

    merged = sources.merge_sources(
        [source([(1, "archive")]), source([(1, "live"), (2, "live")]), source([(2, None), (3, None)])]
    )
    assert rows(merged, "seqno", "payload", "priority") == [
        (1, "archive", 0),
        (2, "live", 1),
        (3, None, 2),
    ]
    with pytest.raises(ValueError):
        sources.merge_sources([])


def test_merge_of_nested_blocks(spark):
    row = (0, 0, 1, [(b"a", [(1, 1, b"x")])])
    one = spark.createDataFrame([row], BLOCK)
    merged = sources.merge_sources([one, one], ["workchain", "shard", "seqno"])
    assert merged.count() == 1
    assert bytes(merged.first().account_blocks[0].addr) == b"a"


def test_read_blocks_with_fewer_fields(spark, folder):
    path = folder("blocks")
    spark.createDataFrame([(0, 0, 1, [(b"a", [(1, 9, b"x")])])], BLOCK).write.parquet(path)
    narrow = sources.read_blocks(spark, path, transaction_fields=["now"])
    flat = narrow.select("seqno", F.inline("account_blocks")).select("seqno", F.inline("transactions"))
    assert [tuple(r) for r in flat.collect()] == [(1, 9)]


def archive_folder(spark, folder):
    path = folder("archives")
    df = spark.createDataFrame([(i // 2, i, 0, b"x%d" % i) for i in range(8)],
                               "archive_id long, object_id long, chunk_no long, data binary")
    sinks.archives(df, path)
    return path


def test_archives_are_pruned_by_id(spark, rows, folder):
    path = archive_folder(spark, folder)
    some = sources.read_archives(spark, path, [1, 3], CHUNK)
    assert rows(some, "archive_id", "object_id") == [(1, 2), (1, 3), (3, 6), (3, 7)]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [archive_id" in plan
    listed = spark.createDataFrame([(2,)], "archive_id long")
    assert rows(sources.read_archives(spark, path, listed, CHUNK), "object_id") == [(4,), (5,)]
    assert sources.read_archives(spark, path, schema=CHUNK).count() == 8


def test_archives_replace_only_their_own_key(spark, rows, folder):
    path = archive_folder(spark, folder)
    sinks.archives(spark.createDataFrame([(1, 99, 0, b"new")],
                   "archive_id long, object_id long, chunk_no long, data binary"), path)
    assert rows(sources.read_archives(spark, path, schema=CHUNK), "archive_id", "object_id") == [
        (0, 0), (0, 1), (1, 99), (2, 4), (2, 5), (3, 6), (3, 7),
    ]


def test_opaque_archives(spark, folder):
    from chainlake.sources.archives import read_opaque_archives

    path = archive_folder(spark, folder)
    files = read_opaque_archives(spark, path, "*.parquet")
    assert files.filter("length = octet_length(content)").count() == files.count() > 0


def test_replay_with_a_snapshot(spark, rows, folder):
    a, b = b"a" * 32, b"b" * 32
    data = [
        (0, 0, 1, [(a, [(1, 1, b"old"), (2, 1, b"mid")]), (b, [(1, 1, b"only")])]),
        (0, 0, 12, [(a, [(3, 2, b"new")])]),
    ]
    path, out = folder("archives"), folder("snapshots")
    flows.store_blocks(spark.createDataFrame(data, BLOCK), path, 10)
    key = {"workchain": 0, "seqno": 12, "kind": "accounts"}
    latest = flows.replay(spark, path, out, key)
    assert rows(latest, "account", "payload") == [(a, b"new"), (b, b"only")]
    assert spark.read.parquet(out).count() == 2
    early = flows.replay(spark, path, ids=[0])
    assert rows(early, "account", "payload") == [(a, b"mid"), (b, b"only")]


def snapshot_frames(spark):
    good = spark.createDataFrame([(1, 2.0)], "account long, value double")
    bad = good.withColumn("value", F.raise_error(F.lit("broken")).cast("double"))
    keys = [{"workchain": 0, "seqno": n, "kind": "accounts"} for n in (1, 2, 3)]
    return list(zip(keys, [good, bad, good]))


def test_snapshots_stop_at_the_first_failure(spark, folder):
    path = folder("snapshots")
    with pytest.raises(Exception, match="broken"):
        sinks.snapshots(snapshot_frames(spark), path, "stop")
    assert [r.seqno for r in spark.read.parquet(path).collect()] == [1]


def test_snapshots_can_go_on(spark, folder):
    path = folder("snapshots")
    results = sinks.snapshots(snapshot_frames(spark), path, "continue")
    assert [error is None for _, error in results] == [True, False, True]
    assert sorted(r.seqno for r in spark.read.parquet(path).collect()) == [1, 3]


def test_snapshots_of_one_table(spark, rows, folder):
    path = folder("snapshots")
    names = "workchain int, seqno long, kind string, account long"
    table = spark.createDataFrame([(0, 1, "a", 5), (-1, 1, "a", 6), (0, 2, "a", 7)], names)
    sinks.snapshots(table, path)
    sinks.snapshots(table.filter("seqno = 2").withColumn("account", F.lit(8)), path)
    assert rows(spark.read.parquet(path), "workchain", "seqno", "account") == [
        (-1, 1, 6), (0, 1, 5), (0, 2, 8),
    ]


def test_snapshot_arguments(spark, folder):
    with pytest.raises(ValueError):
        sinks.snapshots([], folder(), "retry")
    with pytest.raises(ValueError):
        sinks.snapshots([({"seqno": 1}, spark.range(1))], folder())


def test_noop(spark):
    assert sinks.noop(spark.range(10)) is None
    assert sinks.noop_count(spark.range(10)) == 10
    failing = spark.range(1).select(F.raise_error(F.lit("seen")))
    with pytest.raises(Exception, match="seen"):
        sinks.noop(failing)


def test_fan_out_of_a_batch(spark):
    seen = []
    sinks.fan_out(
        spark.range(5),
        [lambda df, n: seen.append((n, df.count())), lambda df, n: seen.append((n, df.agg(F.sum("id")).first()[0]))],
    )
    assert seen == [(0, 5), (0, 10)]


KAFKA = {"topic": "t", "brokers": "b:9092", "group_id": "g"}


def test_kafka_defaults():
    assert sinks.kafka_options(KAFKA) == {
        "topic": "t",
        "kafka.bootstrap.servers": "b:9092",
        "kafka.acks": "1",
        "kafka.linger.ms": "0",
        "kafka.batch.size": "25600000",
        "kafka.compression.type": "none",
        "kafka.max.block.ms": "6000",
        "kafka.delivery.timeout.ms": "5000",
        "kafka.request.timeout.ms": "5000",
    }


def test_kafka_settings():
    options = sinks.kafka_options(
        {**KAFKA, "session_timeout_ms": 1, "message_timeout_ms": None, "message_max_size": 9}
    )
    assert options["kafka.max.block.ms"] == "1"
    assert options["kafka.max.request.size"] == "9"
    assert "kafka.delivery.timeout.ms" not in options


@pytest.mark.parametrize(
    "settings",
    [
        {**KAFKA, "unknown": 1},
        {"topic": "t", "brokers": "b"},
        {**KAFKA, "security_config": {"kind": "Sasl"}},
        {**KAFKA, "security_config": {"kind": "Ssl", "extra": 1}},
        {**KAFKA, "security_config": {"kind": "Ssl", "security_protocol": "SSL"}},
    ],
)
def test_kafka_rejects_unknown_or_missing_settings(settings):
    with pytest.raises(ValueError):
        sinks.kafka_options(settings)


def test_kafka_security(tmp_path):
    names = ("ca", "key", "certificate")
    for name in names:
        (tmp_path / name).write_text(f"PEM {name}")
    security = {"kind": "Ssl", "security_protocol": "SSL"}
    security |= {f"ssl_{name}_location": str(tmp_path / name) for name in names}
    options = sinks.kafka_options({**KAFKA, "security_config": security})
    assert options["kafka.security.protocol"] == "SSL"
    assert options["kafka.ssl.truststore.certificates"] == "PEM ca"
    assert "kafka.ssl.endpoint.identification.algorithm" not in options
    security["enable_ssl_certificate_verification"] = False
    options = sinks.kafka_options({**KAFKA, "security_config": security})
    assert options["kafka.ssl.endpoint.identification.algorithm"] == ""


def test_kafka_columns(spark):
    df = spark.createDataFrame(
        [(b"k", b"v", 3, 1700000000000)], "key binary, value binary, partition int, event_ms long"
    )
    rows = sinks.kafka_columns(df)
    assert rows.columns == ["key", "value", "partition", "headers"]
    header = rows.first().headers[0]
    assert (header.key, bytes(header.value)) == ("event_ms", b"1700000000000")
    assert sinks.kafka(df, KAFKA) is not None


def test_session_scratch_needs_a_shared_folder_on_a_cluster(spark):
    from chainlake.session import scratch_dir

    class Conf(dict):
        def get(self, name, default=None):
            return dict.get(self, name, default)

    class Cluster:
        conf = Conf({"spark.master": "yarn"})

    with pytest.raises(RuntimeError):
        scratch_dir(Cluster, "x")
    Cluster.conf["spark.checkpoint.dir"] = "hdfs:///shared/"
    assert scratch_dir(Cluster, "x").startswith("hdfs:///shared/x-")


def test_merge_keeps_rows_with_null_keys(spark, rows):
    schema = "seqno long, part string, payload string"
    first = spark.createDataFrame([(1, "a", "x"), (None, "a", "y"), (2, None, "z")], schema)
    second = spark.createDataFrame([(None, "a", "late"), (None, None, "n"), (3, "c", "w")], schema)
    merged = sources.merge_sources([first, second], ["seqno", "part"])
    assert rows(merged, "payload") == [("n",), ("w",), ("x",), ("y",), ("z",)]
