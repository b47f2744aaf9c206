"""Nested blocks to flat, keyed and routed transaction records."""

from __future__ import annotations

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import (
    content_key,
    event_ms,
    event_time,
    is_masterchain,
    partition_of,
)

__all__ = [
    "archive_catalog",
    "bundle",
    "content_key",
    "event_time",
    "flatten_transactions",
    "pack_payload",
    "route_partition",
    "to_sink_record",
    "unpack_payload",
    "valid_block",
]


#: Bytes of an account's address.
ADDRESS_BYTES = 32


def valid_block() -> Column:
    """True if every account and transaction of the block row is readable.

    An address must have 32 bytes, as the route is cut from its first one.
    """

    def bad_transaction(tx: Column) -> Column:
        return tx.isNull() | tx["payload"].isNull() | tx["now"].isNull()

    def bad_account(account: Column) -> Column:
        return (
            account.isNull()
            | account["addr"].isNull()
            | (F.octet_length(account["addr"]) != ADDRESS_BYTES)
            | account["transactions"].isNull()
            | F.exists(account["transactions"], bad_transaction)
        )

    return ~F.coalesce(F.exists("account_blocks", bad_account), F.lit(False))


def flatten_transactions(blocks: DataFrame, validate: bool = False) -> DataFrame:
    """One row per transaction of each block; works on streams as well.

    Two generators and no shuffle. A block without transactions gives no rows.
    With ``validate`` an unreadable item (null account, transaction, payload or
    time) fails the job before any row of its block is produced.
    """
    if validate:
        name = F.concat_ws(":", "workchain", "shard", "seqno")
        message = F.concat(F.lit("unreadable item in block "), name)
        blocks = blocks.filter(
            F.when(valid_block(), F.lit(True)).otherwise(
                F.raise_error(message).cast("boolean")
            )
        )
    accounts = blocks.select("workchain", "shard", "seqno", F.inline("account_blocks"))
    return accounts.select(
        "workchain", "shard", "seqno", "addr", F.inline("transactions")
    )


def route_partition(df: DataFrame) -> DataFrame:
    """Add ``partition``: 0 for masterchain blocks, else 1 to 8 by address.

    The block decides what is masterchain, not the account. Partition 0 takes
    every masterchain row, so the column is for the sink and is no good key
    for a shuffle.
    """
    return df.withColumn("partition", partition_of(is_masterchain(), F.col("addr")))


def to_sink_record(transactions: DataFrame, value: str = "payload") -> DataFrame:
    """``key, value, partition, event_ms`` of flat transactions.

    The key hashes the unpacked payload; ``value`` names the column to send,
    for example the packed one.
    """
    return route_partition(transactions).select(
        content_key("payload").alias("key"),
        F.col(value).alias("value"),
        "partition",
        event_ms("now").alias("event_ms"),
    )


#: Compression level of packed payloads.
PACK_LEVEL = 3


def pack_payload(df: DataFrame, level: int = PACK_LEVEL, column: str = "payload") -> DataFrame:
    """Compress each payload on its own; adds ``packed``, ``raw_size``, ``packed_size``.

    Spark has no function for this codec (Zstandard), so the payloads alone go
    through Arrow batches; one compressor serves a batch, and every payload becomes
    a frame of its own. A record that cannot be packed fails the job.
    """

    def pack(values: pa.Array) -> pa.Array:
        compress = zstandard.ZstdCompressor(level).compress
        return pa.array([compress(value) for value in values.to_pylist()], pa.binary())

    packed = df.withColumn("packed", F.arrow_udf(pack, "binary")(F.col(column)))
    return packed.withColumns(
        {
            "raw_size": F.octet_length(column).cast("long"),
            "packed_size": F.octet_length("packed").cast("long"),
        }
    )


def unpack_payload(df: DataFrame, column: str = "packed") -> DataFrame:
    """Add ``unpacked``, the payload in a column of frames."""

    def unpack(values: pa.Array) -> pa.Array:
        expand = zstandard.ZstdDecompressor().decompress
        return pa.array([expand(value) for value in values.to_pylist()], pa.binary())

    return df.withColumn("unpacked", F.arrow_udf(unpack, "binary")(F.col(column)))


def bundle(blocks: DataFrame, blocks_per_archive: int) -> DataFrame:
    """Add ``archive_id`` and ``closed`` to each block.

    Archives take a fixed span of sequence numbers and are named by its start.
    The closing rule is ours: an archive is closed once a block of a later one
    exists. The newest id comes from a scalar subquery over ``seqno`` alone.
    """
    if blocks_per_archive < 1:
        raise ValueError("blocks_per_archive must be positive")
    span = F.lit(blocks_per_archive).cast("long")
    archive_id = F.col("seqno") - F.pmod(F.col("seqno"), span)
    newest = blocks.agg(F.max("seqno").alias("m")).select(
        (F.col("m") - F.pmod(F.col("m"), span)).alias("newest")
    )
    return blocks.withColumn("archive_id", archive_id).withColumn(
        "closed", F.col("archive_id") < newest.scalar()
    )


def archive_catalog(bundled: DataFrame, size: Column | str) -> DataFrame:
    """One row per archive; ``size`` is null while the archive is open."""
    size = F.col(size) if isinstance(size, str) else size
    return bundled.groupBy("archive_id").agg(
        F.count(F.lit(1)).alias("blocks"),
        F.min("seqno").alias("first_seqno"),
        F.max("seqno").alias("last_seqno"),
        F.sum(F.when(F.col("closed"), size)).alias("size"),
        F.bool_and("closed").alias("closed"),
    )
