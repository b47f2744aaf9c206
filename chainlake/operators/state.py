"""Latest state per key by replay of ordered changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import columns

#: Columns that a hash aggregate can keep in place.
FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
ORDERED = (*FIXED_WIDTH, T.StringType, T.BinaryType)


def latest_state(
    changes: DataFrame,
    key: str | Sequence[str] = "account",
    order: str | Sequence[str] = "seqno",
) -> DataFrame:
    """One row per key: the change that comes last in ``order``.

    Every map task keeps one row per key before the shuffle, so a busy account
    costs no more than a quiet one. ``order`` should be unique inside a key.
    With a single ordering column and columns of fixed width alone the aggregate is
    a hash aggregate. Otherwise the row is kept as one value and compared once, with
    what orders it at its front, so that nothing is in a partial row twice. Runs on
    streams in update or complete mode.
    """
    key, order = columns(key), columns(order)
    rest = [name for name in changes.columns if name not in key]
    if len(order) == 1 and all(isinstance(changes.schema[n].dataType, FIXED_WIDTH) for n in rest):
        newest = [F.max_by(name, order[0]).alias(name) for name in rest]
        return changes.groupBy(*key).agg(*newest).select(*changes.columns)
    others = [name for name in rest if name not in order]
    if all(isinstance(changes.schema[n].dataType, ORDERED) for n in others):
        last = F.max(F.struct(*order, *others))
    else:  # a map has no order
        last = F.max_by(F.struct(*order, *others), F.struct(*order))
    last = changes.groupBy(*key).agg(last.alias("_last")).select(*key, "_last.*")
    return last.select(*changes.columns)


def account_changes(transactions: DataFrame) -> DataFrame:
    """State changes of flat transactions: the account's address and payload."""
    return transactions.select(
        F.col("addr").alias("account"),
        "workchain",
        "seqno",
        "lt",
        "now",
        "payload",
    )
