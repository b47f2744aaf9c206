"""Replay of many small archives: what a batch costs besides its rows."""

from pyspark.sql import functions as F

from chainlake import sources, streaming
from chainlake.plans import flows, views
from chainlake.session import LISTING_TASKS, listing_session
from chainlake.streaming import replay

ARCHIVES = 90


def test_session_for_listing_has_the_settings_of_the_first(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    before = spark.conf.getAll
    try:
        own = listing_session(spark)
        cores = str(spark.sparkContext.defaultParallelism)
        assert own.conf.get("spark.sql.shuffle.partitions") == "5" and own.conf.get(LISTING_TASKS) == cores
        own.conf.set("spark.sql.shuffle.partitions", "6")
        assert spark.conf.getAll == before and spark.conf.get(LISTING_TASKS) != cores
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_files_of_a_batch_are_not_listed_one_by_one(spark, folder, rows, monkeypatch):
    path, order, queries = folder("archives"), ["seqno", "lt", "payload"], []
    found = views.blocks(spark, "/root/testdata/sf0.001", 10).withColumn("seqno", F.pmod("seqno", F.lit(10 * ARCHIVES)))
    flows.store_blocks(found, path, 10)
    start = replay.follow_state
    monkeypatch.setattr(replay, "follow_state", lambda *args: queries.append(start(*args)) or queries[-1])
    latest = streaming.follow_archives(spark, path, folder("log"), folder("check"), order, max_files_per_trigger=ARCHIVES)
    assert rows(latest) == rows(flows.replay(spark, path, order=order).select(*latest.columns))
    assert len(rows(sources.read_archives(spark, path).select("archive_id").distinct())) == ARCHIVES
    tracker = spark.sparkContext.statusTracker()
    jobs = tracker.getJobIdsForGroup(str(queries[0].runId))
    tasks = [tracker.getStageInfo(s).numTasks for j in jobs for s in tracker.getJobInfo(j).stageIds if tracker.getStageInfo(s)]
    assert tasks and max(tasks) < ARCHIVES / 2
