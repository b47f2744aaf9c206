"""Views in the shape of the operators' inputs, over the test tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.tags import EMPTY_ETAG, quoted_etag
from ..functions.times import utc_timestamp
from ..operators.objects import cut

# Fixed values shared with the SQL checks.
CHUNK_SIZE = 700
PART_SIZE = 1024
BLOCKS_PER_ARCHIVE = 1000
OBJECTS_PER_ARCHIVE = 100

#: What tells blocks apart.
BLOCK_KEY = ("workchain", "shard", "seqno")

#: Lines of a block at most.
BLOCK_LINES = 8

#: Hexadecimal digits of the payload's digest that lines of a large order are dealt by.
SLICE_DIGITS = 5

#: Hash buckets that lines are counted in by order, and the lines of a bucket above which
#: none of its orders is left to one task.
ORDER_BUCKETS = 1 << 16
BUCKET_LINES = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def payload() -> Column:
    """Payload bytes of a line: its whole-number and text columns."""
    names = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    flags = ["l_returnflag", "l_linestatus"]
    text = F.concat_ws("|", *(F.col(n).cast("string") for n in names), *flags)
    return F.encode(text, "utf-8")


def workchain() -> Column:
    return F.when(F.col("o_orderstatus") == "F", F.lit(-1)).otherwise(F.lit(0))


def address(part: Column | str) -> Column:
    """32-byte account address of a part."""
    part = F.col(part) if isinstance(part, str) else part
    return F.unhex(F.sha2(part.cast("string").cast("binary"), 256))


def part_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line: ``seqno, part, lt, now, payload``."""
    return as_lines(table(spark, sf_dir, "lineitem"))


def as_lines(items: DataFrame, *others: str) -> DataFrame:
    return items.select(
        *others,
        F.col("l_orderkey").alias("seqno"),
        F.col("l_partkey").alias("part"),
        F.col("l_linenumber").cast("long").alias("lt"),
        F.unix_seconds(utc_timestamp("l_shipdate")).alias("now"),
        payload().alias("payload"),
    )


def by_crowding(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of the keys that one task can take, and of those that may be too large for it.

    Rows are counted by hash buckets of their key: small partial counts and at most
    :data:`ORDER_BUCKETS` rows to broadcast. Rows without a key are in neither.
    """
    rows = rows.filter(F.col(key).isNotNull())
    bucket = F.pmod(F.xxhash64(key), F.lit(ORDER_BUCKETS))
    counts = rows.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_size"))
    crowded = F.broadcast(counts.filter(F.col("_size") > BUCKET_LINES).select("_bucket"))
    found = bucket == F.col("_bucket")
    return rows.join(crowded, found, "left_anti"), rows.join(crowded, found, "left_semi")


def in_shards(lines: DataFrame, most: int = BLOCK_LINES) -> DataFrame:
    """Add ``shard``: the rank of a line in its order by the payload's digest and the time, over ``most``.

    So no block has more than ``most`` lines, whatever the size of an order, and content
    alone decides, up to which of equal lines is which.
    """
    few, many = by_crowding(lines, "seqno")
    return ranked_whole(few, most).unionByName(ranked_in_slices(many, most))


def shard_of(rank: Column, most: int) -> Column:
    return F.floor(rank / most).cast("long")


def ranked_whole(lines: DataFrame, most: int) -> DataFrame:
    """Shards of lines in orders that one task can put in order."""
    inside = Window.partitionBy("seqno").orderBy(F.unhex(F.sha2("payload", 256)), "now")
    return lines.withColumn("shard", shard_of(F.row_number().over(inside) - 1, most))


def ranked_in_slices(lines: DataFrame, most: int) -> DataFrame:
    """The same for orders of any size.

    An order of no more than ``most`` lines has one block and needs no rank. In a larger one
    ranks are counted in two levels, inside slices of equal leading digits and over the
    slices, of which there is a fixed number: no order is put in order by one task.
    """
    sizes = lines.groupBy("seqno").agg(F.count(F.lit(1)).alias("_size"))
    small, large = sizes.filter(F.col("_size") <= most), sizes.filter(F.col("_size") > most)
    whole = lines.join(small.select("seqno"), "seqno", "left_semi").withColumn("shard", F.lit(0).cast("long"))
    digest = F.sha2("payload", 256)
    sliced = (
        lines.join(large.select("seqno"), "seqno", "left_semi")
        .withColumns({"_digest": digest, "_slice": F.substring(digest, 1, SLICE_DIGITS)})
        .repartition("seqno", "_slice")
    )
    inside = Window.partitionBy("seqno", "_slice").orderBy("_digest", "now")
    before = Window.partitionBy("seqno").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        sliced.groupBy("seqno", "_slice")
        .agg(F.count(F.lit(1)).alias("_lines"))
        .select("seqno", "_slice", F.coalesce(F.sum("_lines").over(before), F.lit(0)).alias("_base"))
    )
    rank = F.col("_base") + F.row_number().over(inside) - 1
    ranked = sliced.join(bases, ["seqno", "_slice"]).withColumn("_rank", rank)
    split = ranked.withColumn("shard", shard_of(F.col("_rank"), most))
    return whole.unionByName(split.select(*whole.columns))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line: ``seqno, addr, lt, now, payload``."""
    return part_lines(spark, sf_dir).select(
        "seqno", address("part").alias("addr"), "lt", "now", "payload"
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat transactions, without going through nested blocks."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seqno"), workchain().alias("workchain")
    )
    return lines(spark, sf_dir).join(orders, "seqno")


def blocks(spark: SparkSession, sf_dir: str, span: int = 1) -> DataFrame:
    """Nested blocks: one per order and shard that has lines.

    Lines are shuffled once, by order and in the columns they have; payloads, ranks, blocks and
    addresses are made where the order then is. Orders that are too large for a task go
    through more shuffles, down to one by block. With ``span`` that many sequence numbers, an
    archive's, come to one task together, as long as they are not too large for it.
    """

    def first(key: str) -> Column:
        return F.col(key) - F.pmod(F.col(key), F.lit(span).cast("long"))

    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seqno"), workchain().alias("workchain")
    )
    few, many = by_crowding(table(spark, sf_dir, "lineitem").withColumn("_first", first("l_orderkey")), "_first")
    # Orders go to their lines in the same exchange: a join by order would not keep archives together.
    beside = orders.select(F.col("seqno").alias("l_orderkey"), first("seqno").alias("_first"), "workchain")
    rows = few.unionByName(beside, allowMissingColumns=True).repartition("_first")
    lines = as_lines(rows, "_first", "workchain")
    order = Window.partitionBy("_first", "seqno")
    inside = order.orderBy(F.col("workchain").isNotNull(), F.unhex(F.sha2("payload", 256)), "now")
    ranked = lines.withColumns({"shard": shard_of(F.row_number().over(inside) - 1, BLOCK_LINES), "_of": F.collect_list("workchain").over(order)})
    whole = ranked.filter(F.col("workchain").isNull()).withColumn("workchain", F.explode("_of")).drop("_of")
    sliced = ranked_in_slices(as_lines(many), BLOCK_LINES)
    return nested(whole, ("_first", *BLOCK_KEY)).unionByName(
        nested(sliced.join(orders, "seqno").repartition(*BLOCK_KEY))
    )


def nested(rows: DataFrame, group: Sequence[str] = BLOCK_KEY) -> DataFrame:
    """Blocks of flat lines with their ``workchain, shard, seqno``, which decide what else is in ``group``."""
    return (
        rows.groupBy(*group, "part")
        .agg(F.collect_list(F.struct("lt", "now", "payload")).alias("transactions"))
        .withColumn("addr", address("part"))
        .groupBy(*group)
        .agg(F.collect_list(F.struct("addr", "transactions")).alias("account_blocks"))
        .select(*BLOCK_KEY, "account_blocks")
    )


def source_rows(orders: DataFrame) -> list[DataFrame]:
    """Overlapping block sources by priority with the time of a block: archive, live network, local."""

    def source(name: str, rows: DataFrame) -> DataFrame:
        text = F.concat_ws("|", F.lit(name), "o_orderstatus", "o_orderpriority")
        return rows.select(F.col("o_orderkey").alias("seqno"), utc_timestamp("o_orderdate").alias("at"), text.alias("payload"))

    return [
        source("archive", orders.filter(F.col("o_orderstatus") == "F")),
        source("live", orders.filter(F.col("o_orderpriority") <= "3")),
        source("local", orders),
    ]


def sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [df.drop("at") for df in source_rows(table(spark, sf_dir, "orders"))]


def document_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("object_id"), F.encode("text", "utf-8").alias("data"), "lang"
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects and sizes; unlabelled documents count as uncommitted (size null)."""
    labelled = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("object_id"), F.lit(True).alias("_labelled")
    )
    size = F.when(F.col("_labelled"), F.octet_length("data").cast("long"))
    return (
        document_bytes(spark, sf_dir)
        .join(labelled, "object_id", "left")
        .select("object_id", size.alias("size"))
    )


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document bytes in chunks that never line up with the parts."""
    return document_bytes(spark, sf_dir).select(
        "object_id", F.posexplode(cut(F.col("data"), CHUNK_SIZE)).alias("chunk_no", "data")
    ).withColumn("chunk_no", F.col("chunk_no").cast("long"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a damaged store would report; the tags are cut directly from the text.

    German documents are absent, French ones have no tag, Spanish ones a wrong
    one.
    """
    parts = F.transform(cut(F.col("data"), PART_SIZE), lambda part: F.md5(part))
    tag = F.md5(F.unhex(F.array_join("_md5s", "")))
    wrong = F.lit(EMPTY_ETAG)
    whole = document_bytes(spark, sf_dir).select("object_id", "lang", parts.alias("_md5s"))
    reported = F.when(
        F.col("lang") != "fr",
        quoted_etag(F.when(F.col("lang") == "es", wrong).otherwise(tag), F.size("_md5s")),
    )
    return whole.filter(F.col("lang") != "de").select("object_id", reported.alias("e_tag"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric samples from the events."""
    return as_samples(table(spark, sf_dir, "events"))


def as_samples(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("sample_id"),
        utc_timestamp("ts").alias("ts"),
        F.col("event_type").alias("metric"),
        F.col("user_id").alias("instance"),
        (F.col("user_id") % 3).alias("job"),
        F.get_json_object("props", "$.k").cast("long").alias("kind"),
        "value",
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_accounts(table(spark, sf_dir, "events"))


def as_accounts(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("account"), F.col("event_id").alias("seqno"), "value"
    )


def ship_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A shipping log from the orders."""
    state = F.col("o_custkey") % 2 == 0
    return table(spark, sf_dir, "orders").select(
        workchain().alias("workchain"),
        F.col("o_orderkey").alias("seqno"),
        F.floor("o_totalprice").alias("bytes"),
        (1 + F.col("o_custkey") % 3).cast("int").alias("attempts"),
        utc_timestamp("o_orderdate").alias("finished_at"),
        ((F.col("o_custkey") % 97) / 10.0).alias("seconds"),
        (F.col("o_orderpriority") == "5-LOW").alias("skipped"),
        F.when(state, F.lit("state")).otherwise(F.lit("archive")).alias("object_type"),
    )
