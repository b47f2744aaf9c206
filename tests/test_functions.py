import hashlib

import pytest
from pyspark.sql import functions as F

from chainlake import functions as fn


@pytest.mark.parametrize(
    "masterchain, first, partition",
    [
        (True, 0x00, 0),
        (True, 0xFF, 0),
        (False, 0x00, 1),
        (False, 0x1F, 1),
        (False, 0x20, 2),
        (False, 0x7F, 4),
        (False, 0x80, 5),
        (False, 0xFF, 8),
    ],
)
def test_partition_of(spark, masterchain, first, partition):
    df = spark.createDataFrame(
        [(-1 if masterchain else 0, bytes([first]) + bytes(31))], "workchain int, addr binary"
    )
    routed = df.select(fn.partition_of(fn.is_masterchain(), F.col("addr")).alias("p"))
    assert routed.first().p == partition
    assert routed.dtypes == [("p", "int")]


def test_content_key_is_binary_sha256(spark):
    df = spark.createDataFrame([(b"abc\xff",)], "payload binary")
    key = df.select(fn.content_key("payload").alias("k")).first().k
    assert bytes(key) == hashlib.sha256(b"abc\xff").digest()


@pytest.mark.parametrize(
    "now, ms", [(1700000000, 1700000000000), (4294967295, 4294967295000), (0, 0)]
)
def test_event_time(spark, now, ms):
    df = spark.createDataFrame([(now,)], "now long")
    row = df.select(
        fn.event_ms("now").alias("ms"), F.unix_millis(fn.event_time("now")).alias("t")
    ).first()
    assert (row.ms, row.t) == (ms, ms)


@pytest.mark.parametrize(
    "reported, expected, matches",
    [
        ('"abc-2"', "abc", True),
        ("abc", "abc", True),
        ("ab", "abc", False),
        (None, "abc", False),
        ('"xabc"', "abc", False),
        ('""abc""', "abc", True),
    ],
)
def test_etag_matches(spark, reported, expected, matches):
    df = spark.createDataFrame([(reported, expected)], "r string, e string")
    assert df.select(fn.etag_matches("r", "e").alias("m")).first().m is matches


@pytest.mark.parametrize(
    "text, seconds", [(10, 10), ("10 seconds", 10), ("1 day", 86400), ("2 hours", 7200), ("1s", 1), ("1h 30m", 5400), ("2days 5 min", 173100)]
)
def test_seconds_of(text, seconds):
    assert fn.seconds_of(text) == seconds


@pytest.mark.parametrize("text", ["", "ten seconds", "1 fortnight", 0, "-1 day", "5", "1.5 hours"])
def test_bad_durations(text):
    with pytest.raises(ValueError):
        fn.seconds_of(text)


def test_utc_timestamp_ignores_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    seen = []
    try:
        for name in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            df = spark.sql("SELECT TIMESTAMP_NTZ'2024-07-01 12:00:00' AS t")
            seen.append(df.select(F.unix_seconds(fn.utc_timestamp("t"))).first()[0])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert seen == [1719835200, 1719835200]


def test_bucket_start_agrees_with_window(spark):
    df = spark.sql("SELECT timestamp_micros(id * 7654321) AS ts FROM range(-50, 50)")
    pair = df.select(
        fn.bucket_start("ts", "10 seconds").alias("a"),
        F.unix_seconds(F.window("ts", "10 seconds").start).alias("b"),
    )
    assert pair.filter("a <> b").count() == 0
