"""The registered queries once more as SQL, as an independent check.

Common table expressions repeat the views; they are put together as text only.
"""

from __future__ import annotations

from ..operators.metrics import ACCEPTED_QUANTILES
from .registry import LOOKBACK, TAIL, TIME_BOUNDS, VALUE_BOUNDS
from .views import (
    BLOCK_LINES,
    BLOCKS_PER_ARCHIVE,
    CHUNK_SIZE,
    OBJECTS_PER_ARCHIVE,
    PART_SIZE,
)

DAY = 86400
WEEK = 7 * DAY

EPOCH = "CAST(floor(epoch({})) AS BIGINT)"

LINES = f"""
lines AS (
  SELECT l_orderkey AS seqno, sha256(CAST(l_partkey AS VARCHAR)) AS addr,
         CAST(l_linenumber AS BIGINT) AS lt, {EPOCH.format("l_shipdate")} AS now,
         concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber,
                   l_returnflag, l_linestatus) AS payload
  FROM lineitem)"""

TRANSACTIONS = f"""{LINES},
transactions AS (
  SELECT CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 0 END AS workchain, lines.*,
         CAST((row_number() OVER (PARTITION BY seqno ORDER BY sha256(payload), now) - 1) // {BLOCK_LINES} AS BIGINT) AS shard
  FROM lines JOIN orders ON o_orderkey = seqno)"""

RECORDS = f"""{TRANSACTIONS},
records AS (
  SELECT sha256(payload) AS key, payload AS value,
         CASE WHEN workchain = -1 THEN 0
              ELSE 1 + (CAST('0x' || substr(addr, 1, 2) AS INTEGER) >> 5)
         END AS partition,
         now * 1000 AS event_ms
  FROM transactions)"""

OBJECTS = """
objects AS (
  SELECT doc_id AS object_id, lang, octet_length(encode(text)) AS size,
         hex(encode(text)) AS h
  FROM documents)"""


def pieces(name: str, number: str, size: int) -> str:
    """CTE that cuts each object's hex text every ``size`` bytes."""
    return f"""
{name} AS (
  SELECT object_id, {number}, substr(h, {number} * {2 * size} + 1, {2 * size}) AS h
  FROM (SELECT object_id, h, unnest(range(0, (size + {size - 1}) // {size})) AS {number}
        FROM objects))"""


PARTS = f"""{OBJECTS},{pieces("parts", "part_no", PART_SIZE)},
digests AS (
  SELECT object_id, part_no, CAST(length(h) // 2 AS BIGINT) AS length, md5(unhex(h)) AS md5
  FROM parts),
etags AS (
  SELECT object_id, md5(unhex(string_agg(md5, '' ORDER BY part_no))) AS etag,
         count(*) AS parts, CAST(sum(length) AS BIGINT) AS size
  FROM digests GROUP BY object_id)"""

PART_DIGESTS = f"""WITH {PARTS}
  SELECT object_id, CAST(part_no AS BIGINT) AS part_no, length, md5 FROM digests"""

CATALOG = """
catalog AS (
  SELECT d.doc_id AS object_id,
         CASE WHEN l.doc_id IS NOT NULL
              THEN CAST(octet_length(encode(text)) AS BIGINT) END AS size
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""

MANIFEST = """
manifest AS (
  SELECT e.object_id,
         CASE lang WHEN 'fr' THEN NULL
                   WHEN 'es' THEN '"d41d8cd98f00b204e9800998ecf8427e-' || parts || '"'
                   ELSE '"' || etag || '-' || parts || '"' END AS e_tag
  FROM etags e JOIN objects o ON o.object_id = e.object_id
  WHERE lang <> 'de')"""

VERIFIED = """
verified AS (
  SELECT e.object_id, e.etag, m.object_id IS NOT NULL AS present, m.e_tag,
         coalesce(starts_with(trim(m.e_tag, '"'), e.etag), false) AS verified
  FROM etags e LEFT JOIN manifest m ON m.object_id = e.object_id)"""

SAMPLES = """
samples AS (
  SELECT event_id AS sample_id, ts, event_type AS metric, user_id AS instance,
         user_id % 3 AS job, CAST(json_extract(props, '$.k') AS BIGINT) AS kind, value
  FROM events)"""


def bucket(seconds: int, ts: str = "ts") -> str:
    epoch = EPOCH.format(ts)
    return f"{epoch} - {epoch} % {seconds}"


def increases(seconds: int = DAY) -> str:
    """CTE of the reset-aware increase of each series per bucket, over raw samples."""
    return f"""{SAMPLES},
stepped AS (
  SELECT *, {bucket(seconds)} AS bucket,
         lag(value) OVER (PARTITION BY metric, instance, job ORDER BY ts, sample_id) AS previous
  FROM samples WHERE value IS NOT NULL),
increases AS (
  SELECT bucket, metric, instance, job,
         sum(CASE WHEN value < previous THEN value ELSE value - previous END) AS increase
  FROM stepped WHERE previous IS NOT NULL GROUP BY bucket, metric, instance, job)"""


LATEST = f"""{SAMPLES},
latest AS (
  SELECT metric, instance, job, max(ts) AS ts, arg_max(value, (ts, sample_id)) AS value
  FROM samples WHERE value IS NOT NULL GROUP BY metric, instance, job)"""

SHIP_LOG = """
ship_log AS (
  SELECT CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 0 END AS workchain,
         o_orderkey AS seqno, CAST(floor(o_totalprice) AS BIGINT) AS bytes,
         CAST(1 + o_custkey % 3 AS INTEGER) AS attempts, o_orderdate AS finished_at,
         (o_custkey % 97) / 10.0 AS seconds, o_orderpriority = '5-LOW' AS skipped,
         CASE WHEN o_custkey % 2 = 0 THEN 'state' ELSE 'archive' END AS object_type
  FROM orders)"""


def le(bounds: list) -> str:
    """Smallest bound that is not below the value."""
    cases = " ".join(f"WHEN value <= {b} THEN {b}" for b in bounds)
    return f"CAST(CASE {cases} ELSE 'infinity'::DOUBLE END AS DOUBLE)"


def sided(left: str, right: str, by: list[str]) -> str:
    """CTE of the summed increases of two metrics, both present."""
    keys = ", ".join(["bucket", *by])
    return f"""{increases()},
sides AS (
  SELECT {keys}, sum(increase) FILTER (WHERE metric = '{left}') AS l,
         sum(increase) FILTER (WHERE metric = '{right}') AS r
  FROM increases GROUP BY {keys} HAVING l IS NOT NULL AND r IS NOT NULL)"""


def instant(name: str, metric: str) -> str:
    return f"""
{name} AS (
  SELECT {bucket(DAY)} AS bucket, instance, job, arg_max(value, (ts, sample_id)) AS value
  FROM samples WHERE metric = '{metric}' AND value IS NOT NULL GROUP BY ALL)"""


def cells(source: str, bounds: list, seconds: int, by: str, ts: str = "ts") -> str:
    return f"""
  SELECT {bucket(seconds, ts)} AS bucket, {by}, {le(bounds)} AS le, count(*) AS observations,
         round(count(*) / {seconds}, 9) AS rate
  FROM {source} GROUP BY ALL"""


def quantile(q: float, by: str) -> str:
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return (
        f"WITH {SAMPLES} SELECT {keys}round(quantile_cont(value, {q}), 9) AS value "
        f"FROM samples {group}"
    )


CUMULATIVE = " UNION ALL ".join(
    f"SELECT bucket, CAST({bound} AS DOUBLE) AS le, count(*) FILTER (WHERE value <= {bound}) AS observations "
    "FROM bucketed GROUP BY bucket"
    for bound in [*VALUE_BOUNDS, "'infinity'::DOUBLE"]
)

ORACLES: dict[str, str] = {
    "block_source": f"""WITH {TRANSACTIONS}
        SELECT workchain, shard, seqno, count(DISTINCT addr) AS accounts,
               count(*) AS transactions
        FROM transactions GROUP BY workchain, shard, seqno""",
    "merge_sources": """WITH sources AS (
          SELECT o_orderkey AS seqno, 0 AS priority,
                 concat_ws('|', 'archive', o_orderstatus, o_orderpriority) AS payload
          FROM orders WHERE o_orderstatus = 'F'
          UNION ALL
          SELECT o_orderkey, 1, concat_ws('|', 'live', o_orderstatus, o_orderpriority)
          FROM orders WHERE o_orderpriority <= '3'
          UNION ALL
          SELECT o_orderkey, 2, concat_ws('|', 'local', o_orderstatus, o_orderpriority)
          FROM orders)
        SELECT seqno, min(priority) AS priority, arg_min(payload, priority) AS payload
        FROM sources GROUP BY seqno""",
    "archive_replay": f"""
        SELECT doc_id - doc_id % {OBJECTS_PER_ARCHIVE} AS archive_id, doc_id AS object_id,
               md5(text) AS md5
        FROM documents""",
    "archive_replay_state": f"""WITH {TRANSACTIONS}
        SELECT account, workchain, seqno, lt, now, payload FROM (
          SELECT addr AS account, *, row_number() OVER (
                   PARTITION BY addr ORDER BY seqno DESC, lt DESC, payload DESC) AS place
          FROM transactions)
        WHERE place = 1""",
    "archive_replay_stream": f"""WITH {TRANSACTIONS}
        SELECT account, workchain, seqno, lt, now, payload FROM (
          SELECT addr AS account, *, row_number() OVER (
                   PARTITION BY addr ORDER BY seqno DESC, lt DESC, payload DESC) AS place
          FROM transactions)
        WHERE place = 1""",
    "committed_tail": f"""WITH {CATALOG}
        SELECT object_id, size
        FROM (SELECT * FROM catalog ORDER BY object_id DESC LIMIT {TAIL})
        WHERE size IS NOT NULL""",
    "backlog_follow": "SELECT event_id, user_id, event_type, value FROM events",
    "chunk_offsets": f"""WITH {OBJECTS},{pieces("chunks", "chunk_no", CHUNK_SIZE)}
        SELECT object_id, CAST(chunk_no AS BIGINT) AS chunk_no,
               CAST(length(h) // 2 AS BIGINT) AS length,
               CAST(chunk_no * {CHUNK_SIZE} AS BIGINT) AS "offset"
        FROM chunks""",
    "flatten_transactions": f"""WITH {TRANSACTIONS}
        SELECT workchain, shard, seqno, addr, lt, now, payload FROM transactions""",
    "content_key": f"WITH {LINES} SELECT seqno, lt, sha256(payload) AS key FROM lines",
    "route_partition": f"""WITH {TRANSACTIONS}
        SELECT workchain, seqno, addr,
               CASE WHEN workchain = -1 THEN 0
                    ELSE 1 + (CAST('0x' || substr(addr, 1, 2) AS INTEGER) >> 5)
               END AS partition
        FROM transactions""",
    "event_time": f"""WITH {LINES}
        SELECT seqno, lt, now * 1000 AS event_ms, now * 1000000 AS event_us FROM lines""",
    "pack_payload": f"""WITH {LINES}
        SELECT lt, count(*) AS records, CAST(sum(length(payload)) AS BIGINT) AS raw_bytes,
               count(*) AS frames
        FROM lines GROUP BY lt""",
    "sink_record": f"WITH {RECORDS} SELECT key, value, partition, event_ms FROM records",
    "kafka_record_counts": f"""WITH {RECORDS}
        SELECT partition, count(*) AS records FROM records GROUP BY partition""",
    "publish_stream": f"""WITH {RECORDS}
        SELECT partition, count(*) AS records, count(DISTINCT key) AS keys,
               max(event_ms) AS last_event_ms
        FROM records GROUP BY partition""",
    "noop_sink": f"WITH {RECORDS} SELECT count(*) AS records FROM records",
    "bundle_archives": f"""WITH bundled AS (
          SELECT o_orderkey AS seqno, floor(o_totalprice) AS bytes,
                 o_orderkey - o_orderkey % {BLOCKS_PER_ARCHIVE} AS archive_id
          FROM orders)
        SELECT archive_id, count(*) AS blocks, min(seqno) AS first_seqno,
               max(seqno) AS last_seqno,
               CASE WHEN archive_id < (SELECT max(archive_id) FROM bundled)
                    THEN CAST(sum(bytes) AS BIGINT) END AS size,
               archive_id < (SELECT max(archive_id) FROM bundled) AS closed
        FROM bundled GROUP BY archive_id""",
    "rechunk_parts": f"""WITH {PARTS}
        SELECT object_id, CAST(part_no AS BIGINT) AS part_no,
               CAST(length(h) // 2 AS BIGINT) AS length, sha256(unhex(h)) AS sha256
        FROM parts""",
    "rechunk_at_offsets": PART_DIGESTS,
    "part_md5": PART_DIGESTS,
    "composite_etag": f"WITH {PARTS} SELECT object_id, etag, parts, size FROM etags",
    "verify_etag": f"""WITH {PARTS},{MANIFEST},{VERIFIED}
        SELECT object_id, etag, present, verified FROM verified""",
    "skip_existing": f"""WITH {PARTS},{MANIFEST},{CATALOG}
        SELECT object_id, size FROM catalog
        WHERE object_id NOT IN (SELECT object_id FROM manifest)""",
    "skip_existing_unchecked": f"""WITH {PARTS},{MANIFEST},{CATALOG}
        SELECT object_id, size FROM catalog
        WHERE object_id % 3 = 0 OR object_id NOT IN (SELECT object_id FROM manifest)""",
    "pending_set": f"""WITH {PARTS},{MANIFEST},{VERIFIED},{CATALOG}
        SELECT c.object_id, c.size, v.etag, e.parts,
               CASE WHEN NOT present THEN 'absent' WHEN e_tag IS NULL THEN 'no_tag'
                    ELSE 'mismatch' END AS reason
        FROM catalog c JOIN verified v ON v.object_id = c.object_id
        JOIN etags e ON e.object_id = c.object_id
        WHERE c.size IS NOT NULL AND NOT verified""",
    "ship_until_verified": f"""WITH {PARTS},{MANIFEST},{CATALOG}
        SELECT e.object_id, etag, parts, e.size, CAST(1 AS INTEGER) AS attempt, CAST(NULL AS VARCHAR) AS reason
        FROM etags e JOIN catalog c ON c.object_id = e.object_id
        WHERE c.size IS NOT NULL
          AND e.object_id NOT IN (SELECT object_id FROM manifest)""",
    "ship_committed_tail": f"""WITH {PARTS},{MANIFEST},{CATALOG}
        SELECT e.object_id, etag, parts, e.size, CAST(1 AS INTEGER) AS attempt, CAST(NULL AS VARCHAR) AS reason
        FROM etags e
        JOIN (SELECT * FROM catalog ORDER BY object_id DESC LIMIT {TAIL}) c
          ON c.object_id = e.object_id
        WHERE c.size IS NOT NULL
          AND e.object_id NOT IN (SELECT object_id FROM manifest)""",
    "archive_sink_roundtrip": f"""
        SELECT doc_id - doc_id % {OBJECTS_PER_ARCHIVE} AS archive_id, count(*) AS objects,
               CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes,
               min(doc_id) AS first_object, max(doc_id) AS last_object
        FROM documents GROUP BY 1""",
    "shipping_summary": f"""WITH {SHIP_LOG}, labelled AS (
          SELECT *, CASE WHEN object_type = 'state' THEN workchain END AS label,
                 NOT skipped AS sent,
                 CASE WHEN object_type = 'archive' AND NOT skipped THEN bytes END AS sent_b
          FROM ship_log)
        SELECT object_type, label AS workchain,
               arg_max(seqno, (finished_at, seqno))
                 FILTER (WHERE sent OR object_type = 'state') AS last_seqno,
               count(*) AS objects, count(*) FILTER (WHERE skipped) AS skipped,
               max(attempts) FILTER (WHERE sent) AS max_attempts,
               CAST(sum(attempts - 1) FILTER (WHERE sent) AS BIGINT) AS retries,
               count(sent_b) AS sized_objects, CAST(sum(sent_b) AS BIGINT) AS sent_bytes,
               max(sent_b) AS largest_bytes
        FROM labelled GROUP BY object_type, label""",
    "shipping_sizes": f"""WITH {SHIP_LOG}
        SELECT object_type, round(quantile_cont(bytes::DOUBLE, 0.999), 9) AS value
        FROM ship_log WHERE object_type = 'archive' AND NOT skipped GROUP BY object_type""",
    "shipping_times": f"""WITH {SHIP_LOG}, times AS (
          SELECT finished_at AS ts, object_type, seconds AS value FROM ship_log)
        {cells("times", TIME_BOUNDS, WEEK, "object_type")}""",
    "latest_state": """
        SELECT user_id AS account, max(event_id) AS seqno, arg_max(value, event_id) AS value
        FROM events GROUP BY user_id""",
    "stream_latest_state": """
        SELECT user_id AS account, max(event_id) AS seqno, arg_max(value, event_id) AS value
        FROM events GROUP BY user_id""",
    "snapshot_roundtrip": """
        SELECT w AS workchain, CAST(1 AS BIGINT) AS seqno, 'accounts' AS kind,
               user_id AS account, max(event_id) AS last_seqno,
               arg_max(value, event_id) AS value
        FROM events, (VALUES (CAST(-1 AS BIGINT)), (CAST(0 AS BIGINT))) AS keys(w)
        GROUP BY w, user_id""",
    "fan_out": """
        SELECT event_type, count(*) AS events, max(event_id) AS last_event, output
        FROM events, (VALUES ('rows'), ('counts')) AS outputs(output)
        GROUP BY event_type, output""",
    "label_select": f"""WITH {SAMPLES}
        SELECT sample_id, metric, instance, job, kind, value FROM samples
        WHERE metric IN ('click', 'purchase') AND job IN (0, 2)
          AND regexp_full_match(CAST(kind AS VARCHAR), '[1-4][0-9]')""",
    "sum_rate": f"""WITH {increases()}
        SELECT bucket, instance, round(sum(increase) / {DAY}, 9) AS rate
        FROM increases WHERE metric = 'click' GROUP BY bucket, instance""",
    "sum_increase": f"""WITH {increases()}
        SELECT bucket, metric, job, round(sum(increase), 9) AS increase
        FROM increases GROUP BY bucket, metric, job""",
    "stream_sum_rate": f"""WITH {increases()}
        SELECT bucket, metric, job, round(sum(increase) / {DAY}, 9) AS rate
        FROM increases GROUP BY bucket, metric, job""",
    "stream_heatmap": f"WITH {SAMPLES} {cells('samples', VALUE_BOUNDS, DAY, 'metric')}",
    "summary_quantile": f"""WITH {SAMPLES}
        SELECT sample_id, instance, job, value FROM samples
        WHERE metric = 'click' AND kind % 7 = {ACCEPTED_QUANTILES.index("0.95")}""",
    "stored_count_rate": f"""WITH {increases()}
        SELECT bucket, job, round(sum(increase) / {DAY}, 9) AS rate
        FROM increases WHERE metric = 'view' GROUP BY bucket, job""",
    "percent_ratio": f"""WITH {sided("click", "view", ["instance"])}
        SELECT bucket, instance, round(l / nullif(r, 0) * 100, 9) AS percent FROM sides""",
    "hit_rate": f"""WITH {sided("error", "view", [])}
        SELECT bucket, round((1 - l / nullif(r, 0)) * 100, 9) AS hit_rate FROM sides""",
    "vector_match": f"""WITH {SAMPLES},{instant("a", "click")},{instant("b", "view")}
        SELECT bucket, instance, job, round(a.value - b.value, 9) AS value
        FROM a JOIN b USING (bucket, instance, job)""",
    "latest_sample": f"""WITH {LATEST}
        SELECT metric, instance, job, epoch_us(ts) AS ts_us, value FROM latest""",
    "agg_across_series": f"""WITH {LATEST}
        SELECT metric, job, min(value) AS min, max(value) AS max,
               round(avg(value), 9) AS avg, round(sum(value), 9) AS sum,
               count(value) AS count
        FROM latest GROUP BY metric, job""",
    "agg_global_min": f"""WITH {LATEST}
        SELECT min(value) AS min FROM latest WHERE metric = 'click'""",
    "heatmap": f"WITH {SAMPLES} {cells('samples', VALUE_BOUNDS, 10, 'metric')}",
    "heatmap_cumulative": f"""WITH {SAMPLES}, bucketed AS (
          SELECT {bucket(DAY)} AS bucket, value FROM samples)
        SELECT bucket, le, observations, round(observations / {DAY}, 9) AS rate
        FROM ({CUMULATIVE})""",
    "bucket_heatmap": f"""WITH {SAMPLES}, counters AS (
          SELECT *, CAST(kind - kind % 25 AS DOUBLE) AS le, {bucket(DAY)} AS bucket
          FROM samples WHERE metric = 'view' AND value IS NOT NULL),
        stepped AS (
          SELECT *, lag(value) OVER (PARTITION BY instance, job, le
                                     ORDER BY ts, sample_id) AS previous
          FROM counters)
        SELECT bucket, le,
               round(sum(CASE WHEN value < previous THEN value
                              ELSE value - previous END) / {DAY}, 9) AS rate
        FROM stepped WHERE previous IS NOT NULL GROUP BY bucket, le""",
    "quantile_series": quantile(0.95, "metric"),
    "quantile_by_instance": quantile(0.999, "instance"),
    "quantile_global": quantile(0.5, ""),
    # Every sketched value must have a rank within the stated error.
    "quantile_sketch": f"""WITH {SAMPLES}
        SELECT instance, true AS within FROM samples WHERE value IS NOT NULL GROUP BY instance""",
    "object_scan": PART_DIGESTS,
    "object_parts_roundtrip": f"WITH {PARTS} SELECT object_id, etag, parts, size FROM etags",
    "acknowledged_blocks": f"""WITH {RECORDS}, done AS (
          SELECT count(DISTINCT (workchain, shard, seqno)) AS blocks, count(*) AS acknowledged FROM transactions)
        SELECT partition, count(*) AS sent, max(event_ms) AS last_event_ms,
               any_value(blocks) AS blocks, any_value(acknowledged) AS acknowledged
        FROM records, done GROUP BY partition""",
    "state_store_latest": """
        SELECT user_id AS account, max(event_id) AS seqno, arg_max(value, event_id) AS value
        FROM events GROUP BY user_id""",
    "state_sum_rate": f"""WITH {increases()}
        SELECT bucket, metric, job, round(sum(increase) / {DAY}, 9) AS rate
        FROM increases GROUP BY bucket, metric, job""",
    "state_percent_ratio": f"""WITH {sided("click", "view", ["instance"])}
        SELECT bucket, instance, round(l / nullif(r, 0) * 100, 9) AS percent FROM sides""",
    "vector_match_lookback": f"""WITH {SAMPLES},{instant("a", "click")},{instant("b", "view")},
        every AS (SELECT bucket, instance, job FROM a UNION SELECT bucket, instance, job FROM b)
        SELECT e.bucket, e.instance, e.job, round(a.value - b.value, 9) AS value
        FROM every e
        ASOF JOIN a ON e.instance = a.instance AND e.job = a.job AND e.bucket >= a.bucket
        ASOF JOIN b ON e.instance = b.instance AND e.job = b.job AND e.bucket >= b.bucket
        WHERE e.bucket - a.bucket <= {LOOKBACK * DAY} AND e.bucket - b.bucket <= {LOOKBACK * DAY}""",
    "quantile_merged": f"""WITH {SAMPLES}
        SELECT metric, count(*) AS samples, true AS within FROM samples WHERE value IS NOT NULL GROUP BY metric""",
    "indexed_select": f"""WITH {SAMPLES}
        SELECT sample_id, metric, instance, job, kind, value FROM samples
        WHERE metric IN ('click', 'purchase') AND job IN (0, 2)
          AND regexp_full_match(CAST(kind AS VARCHAR), '[1-4][0-9]')""",
    "indexed_label_values": f"""WITH {SAMPLES}
        SELECT DISTINCT kind FROM samples WHERE metric = 'click' AND kind IS NOT NULL""",
    "count_rate": f"""WITH {SAMPLES}
        SELECT {bucket(DAY)} AS bucket, metric, job, count(*) AS observations,
               round(count(*) / {DAY}, 9) AS rate
        FROM samples GROUP BY ALL""",
    "label_values": f"""WITH {SAMPLES}
        SELECT DISTINCT kind FROM samples WHERE metric = 'click' AND kind IS NOT NULL""",
}

ORACLES["stream_merge_sources"] = ORACLES["merge_sources"]
ORACLES["stream_closed_archives"] = f"""
    SELECT archive_id, blocks, first_seqno, last_seqno, size FROM ({ORACLES["bundle_archives"]}) WHERE closed"""
