import hashlib
import os

import pytest
from pyspark.sql import functions as F

from chainlake import catalog, integrity
from chainlake.plans import flows
from chainlake.schemas import MANIFEST
from test_objects import CONTENTS, chunk_table


def ids(df):
    return sorted(r.object_id for r in df.collect())


@pytest.fixture
def five(spark):
    return spark.createDataFrame(
        [(1, 10), (2, 20), (3, None), (4, 40), (5, None)], "object_id long, size long"
    )


@pytest.mark.parametrize("n, expected", [(3, [4]), (0, []), (9, [1, 2, 4]), (1, [])])
def test_tail_is_cut_before_the_uncommitted_are_dropped(five, n, expected):
    assert ids(catalog.committed_tail(five, n)) == expected


def test_tail_default_and_bounds(five):
    assert ids(catalog.committed_tail(five)) == [4]
    with pytest.raises(ValueError):
        catalog.committed_tail(five, -1)
    plan = catalog.committed_tail(five, 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_skip_existing(spark):
    candidates = spark.createDataFrame([(1,), (2,), (3,)], "object_id long")
    manifest = spark.createDataFrame([(2, None)], MANIFEST)
    assert ids(catalog.skip_existing(candidates, manifest)) == [1, 3]
    assert ids(catalog.skip_existing(candidates, manifest, enable_duplication=True)) == [1, 2, 3]


def test_a_failed_check_counts_as_absent(spark):
    candidates = spark.createDataFrame([(1,), (2,), (3,)], "object_id long")
    manifest = spark.createDataFrame(
        [(1, "timeout"), (2, None)], "object_id long, error string"
    )
    found = catalog.skip_existing(
        candidates, manifest, check_failed=manifest.error.isNotNull()
    )
    assert ids(found) == [1, 3]


def test_verify_and_pending(spark, rows):
    etags = spark.createDataFrame(
        [(1, "aa", 5, 0), (2, "bb", 5, 0), (3, "cc", 5, 1), (4, "dd", None, 0), (5, "ee", 5, 9)],
        "object_id long, etag string, size long, attempts int",
    )
    manifest = spark.createDataFrame([(1, '"aa-1"'), (2, None), (3, '"zz-1"')], MANIFEST)
    checked = integrity.verify(etags, manifest)
    assert rows(checked, "object_id", "present", "verified") == [
        (1, True, True),
        (2, True, False),
        (3, True, False),
        (4, False, False),
        (5, False, False),
    ]
    assert rows(integrity.pending(etags, manifest), "object_id", "reason") == [
        (2, "no_tag"),
        (3, "mismatch"),
        (5, "absent"),
    ]
    assert ids(integrity.pending(etags, manifest, max_attempts=5)) == [2, 3]
    assert ids(integrity.unsized(etags)) == [4]


def test_nothing_is_pending_after_a_clean_publish(spark):
    etags = flows.expected_etags(chunk_table(spark, CONTENTS, [700]), 1024)
    assert integrity.pending(etags, integrity.manifest_of(etags)).count() == 0


@pytest.fixture
def shipment(spark):
    sizes = [(k, len(c)) for k, c in CONTENTS.items()] + [(8, 0), (9, None)]
    return (
        spark.createDataFrame(sizes, "object_id long, size long"),
        chunk_table(spark, CONTENTS, [700]),
        spark.createDataFrame([(2, '"x-1"')], MANIFEST),
    )


def test_ship_leaves_out_present_and_unsized(spark, rows, folder, shipment):
    done = flows.ship(spark, *shipment, folder("store"), 1024)
    assert rows(done, "object_id", "size", "attempt") == [
        (1, 5120, 1),
        (3, 3, 1),
        (4, 1025, 1),
        (8, 0, 1),
    ]


def test_ship_can_stop_on_an_unknown_size(spark, folder, shipment):
    with pytest.raises(RuntimeError, match="unknown size"):
        flows.ship(spark, *shipment, folder("store"), 1024, on_error="stop")


def test_ship_gives_up_on_what_never_verifies(spark, rows, folder, shipment):
    wrong, chunks, manifest = shipment
    wrong = wrong.filter("object_id = 1").selectExpr("object_id", "size + 1 AS size")
    limit = {"max_attempts": 2, "retry_delay": "1 second"}
    with pytest.raises(RuntimeError, match="after 2 attempts"):
        flows.ship(spark, wrong, chunks, manifest, folder("store"), 1024, limit, on_error="stop")
    right = shipment[0].filter("object_id = 3")
    done = flows.ship(spark, wrong.unionByName(right.select(wrong.columns)), chunks, manifest, folder("store"), 1024, limit)
    assert rows(done, "object_id", "attempt", "reason", "etag")[0] == (1, 2, "unverified", None)
    assert rows(done, "object_id", "attempt", "reason")[1] == (3, 1, None)


def test_shipping_summary(spark, rows):
    log = spark.createDataFrame(
        [
            (0, 5, 100, 1, "2024-01-01 00:00:05", 1.0, False, "archive"),
            (0, 6, 900, 4, "2024-01-01 00:00:09", 1.0, True, "archive"),
            (-1, 7, 300, 3, "2024-01-01 00:00:02", 1.0, False, "archive"),
            (0, 8, 100, 1, "2024-01-01 00:00:05", 1.0, False, "state"),
            (0, 9, 100, 1, "2024-01-01 00:00:06", 1.0, True, "state"),
            (-1, 3, 100, 2, "2024-01-01 00:00:06", 9.0, False, "state"),
        ],
        "workchain int, seqno long, bytes long, attempts int, finished_at string,"
        "seconds double, skipped boolean, object_type string",
    ).selectExpr("*", "to_timestamp(finished_at) AS t").drop("finished_at")
    log = log.withColumnRenamed("t", "finished_at")
    summary = catalog.shipping_summary(log)
    assert rows(summary, "object_type", "workchain", "last_seqno", "max_attempts", "sent_bytes") == [
        # A skipped archive does not move the last seqno, a skipped state does.
        ("archive", None, 5, 3, 400),
        ("state", -1, 3, 2, None),
        ("state", 0, 9, 1, None),
    ]
    assert rows(catalog.shipping_sizes(log)) == [("archive", 299.8)]
    assert rows(catalog.shipping_times(log, [2]), "object_type", "le", "observations") == [
        ("archive", 2.0, 3),
        ("state", 2.0, 2),
        ("state", float("inf"), 1),
    ]


def test_md5_of_parts(spark):
    content = os.urandom(3000)
    parts = spark.createDataFrame([(1, 0, content)], "object_id long, part_no long, data binary")
    row = integrity.part_md5(parts).first()
    assert (row.md5, row.length) == (hashlib.md5(content).hexdigest(), 3000)


def test_damaged_parts_are_shipped_again(spark, rows, folder, shipment):
    attempts = []

    def unreliable(parts, path):
        attempts.append(path)
        if len(attempts) == 1:
            broken = (F.col("object_id") == 1) & (F.col("part_no") == 2)
            lost = (F.col("object_id") == 4) & (F.col("part_no") == 1)
            parts = parts.withColumn("data", F.when(broken, F.lit(b"?")).otherwise(F.col("data")))
            parts = parts.filter(~lost)
        flows.store(parts, path)

    done = flows.ship(spark, *shipment, folder("store"), 1024, put=unreliable)
    assert rows(done, "object_id", "attempt") == [(1, 2), (3, 1), (4, 2), (8, 1)]
    assert len(attempts) == 2


def test_catch_up_ships_the_tail_only(spark, rows, folder, shipment):
    done = flows.ship_committed_tail(spark, *shipment, folder("store"), 1024)
    assert rows(done, "object_id") == [(4,), (8,)]
    config = {"last_archives_to_upload": 4, "enable_duplication": True}
    done = flows.ship_committed_tail(spark, *shipment, folder("store"), 1024, config)
    assert rows(done, "object_id") == [(3,), (4,), (8,)]


def test_shipping_settings():
    defaults = flows.ShipConfig.of(None)
    assert (defaults.retry_delay, defaults.enable_duplication) == ("1 second", False)
    assert defaults.last_archives_to_upload == 3
    for bad in ({"bucket_name": "x"}, {"retry_delay": "soon"}):
        with pytest.raises(ValueError):
            flows.ShipConfig.of(bad)
