"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the test tables, ``BENCH_CPUS`` the local threads. Each
query runs once to warm up and is then timed; the whole result is computed and
thrown away. The two stored inputs (blocks, chunks) are written before the clock
starts, as a running system would find them.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from chainlake import blocks, get_session, scratch_dir, sinks, sources  # noqa: E402
from chainlake.plans import flows, views  # noqa: E402
from chainlake.plans.registry import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ROUNDS = int(os.environ.get("BENCH_ROUNDS", "2"))

HEADLINE = (
    "flatten_transactions kafka_record_counts sink_record pack_payload noop_sink "
    "merge_sources bundle_archives latest_state archive_replay_state "
    "chunk_offsets rechunk_parts composite_etag verify_etag pending_set "
    "ship_until_verified archive_sink_roundtrip shipping_summary "
    "sum_rate sum_increase percent_ratio hit_rate vector_match latest_sample "
    "agg_across_series heatmap heatmap_cumulative quantile_series "
    "quantile_by_instance count_rate label_values stream_sum_rate publish_stream"
).split()


def main() -> None:
    spark = get_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.log.level": "ERROR",
        },
    )
    block_path, chunk_path = scratch_dir(spark, "bench-blocks"), scratch_dir(spark, "bench-chunks")
    views.blocks(spark, SF_DIR).write.parquet(block_path)
    views.chunks(spark, SF_DIR).write.parquet(chunk_path)
    stored_blocks = sources.read_blocks(spark, block_path)
    stored_chunks = spark.read.parquet(chunk_path)
    placed_chunks = stored_chunks.withColumn("offset", F.col("chunk_no") * views.CHUNK_SIZE)
    chunk_bytes = stored_chunks.agg(F.sum(F.octet_length("data"))).first()[0]
    records = blocks.flatten_transactions(stored_blocks).count()

    def best(run) -> float:
        run()
        times = []
        for _ in range(ROUNDS):
            began = time.perf_counter()
            run()
            times.append(time.perf_counter() - began)
        return round(min(times), 4)

    timings = {
        "stored_publish": best(lambda: sinks.noop(flows.publish(stored_blocks, pack=False))),
        "stored_publish_packed": best(lambda: sinks.noop(flows.publish(stored_blocks))),
        "stored_etags": best(
            lambda: sinks.noop(flows.expected_etags(stored_chunks, views.PART_SIZE))
        ),
        "stored_etags_at_offsets": best(
            lambda: sinks.noop(flows.expected_etags(placed_chunks, views.PART_SIZE))
        ),
    }
    for name in HEADLINE:
        timings[name] = best(lambda: sinks.noop(QUERIES[name](spark, SF_DIR)))

    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "records_per_second": round(records / timings["stored_publish"]),
                "packed_records_per_second": round(
                    records / timings["stored_publish_packed"]
                ),
                "etag_mb_per_second": round(chunk_bytes / 1e6 / timings["stored_etags"], 2),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
