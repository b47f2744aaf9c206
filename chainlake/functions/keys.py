"""Record key, routing and time of a transaction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# They must equal what consumers of the topic expect.
MASTERCHAIN = -1  # workchain of masterchain blocks
MASTERCHAIN_PARTITION = 0
ADDRESS_PREFIX_BITS = 3  # eight account partitions, 1 to 8


def content_key(payload: Column | str) -> Column:
    """32-byte SHA-256 of the payload bytes, as binary."""
    return F.unhex(F.sha2(payload, 256))


def is_masterchain(workchain: Column | str = "workchain") -> Column:
    """True for blocks of the masterchain."""
    return F.col(workchain) == MASTERCHAIN if isinstance(workchain, str) else (
        workchain == MASTERCHAIN
    )


def partition_of(masterchain: Column, addr: Column | str) -> Column:
    """Topic partition: 0 for masterchain blocks, else one of 1 to 8.

    The account partitions follow the leading bits of the address. Only the
    first byte is turned into hex, which also keeps it unsigned.
    """
    first_byte = F.conv(F.hex(F.substring(addr, 1, 1)), 16, 10).cast("int")
    account_partition = F.shiftright(first_byte, 8 - ADDRESS_PREFIX_BITS) + F.lit(1)
    return F.when(masterchain, F.lit(MASTERCHAIN_PARTITION)).otherwise(account_partition)


def event_time(now: Column | str) -> Column:
    """Timestamp of a time given in whole seconds."""
    return F.timestamp_seconds(now)


def event_ms(now: Column | str) -> Column:
    """The same time as a long in milliseconds."""
    now = F.col(now) if isinstance(now, str) else now
    return now.cast("long") * F.lit(1000).cast("long")
