"""Schemas of the tables the operators exchange."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TRANSACTION = StructType(
    [
        StructField("lt", LongType()),
        StructField("now", LongType()),  # unsigned 32-bit seconds need a long
        StructField("payload", BinaryType()),
    ]
)


def block_schema(transaction_fields: Sequence[str] | None = None) -> StructType:
    """Schema of a block, with all or only the named transaction fields.

    The account blocks are an array of pairs and not a map: an array keeps the
    order and repeated keys.
    """
    fields = TRANSACTION.fields
    if transaction_fields is not None:
        fields = [TRANSACTION[name] for name in transaction_fields]
    account_block = StructType(
        [
            StructField("addr", BinaryType()),
            StructField("transactions", ArrayType(StructType(fields))),
        ]
    )
    return StructType(
        [
            StructField("workchain", IntegerType()),
            StructField("shard", LongType()),
            StructField("seqno", LongType()),
            StructField("account_blocks", ArrayType(account_block)),
        ]
    )


BLOCK = block_schema()

CHUNK = StructType(
    [
        StructField("object_id", LongType()),
        StructField("chunk_no", LongType()),
        StructField("data", BinaryType()),
    ]
)

MANIFEST = StructType(
    [StructField("object_id", LongType()), StructField("e_tag", StringType())]
)

SAMPLE = StructType(
    [
        StructField("sample_id", LongType()),
        StructField("ts", TimestampType()),
        StructField("metric", StringType()),
        StructField("instance", LongType()),
        StructField("job", LongType()),
        StructField("kind", LongType()),
        StructField("value", DoubleType()),
    ]
)
