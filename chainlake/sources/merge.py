"""Sources in order of priority."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.common import columns


def merge_sources(
    sources: Sequence[DataFrame], key: str | Sequence[str] = "seqno"
) -> DataFrame:
    """Union of the sources; a key found in an earlier one is not taken again.

    The first source has the highest priority. Which source a key comes from is
    settled on keys and priorities alone, by partial aggregates of fixed width; whole
    rows are only joined to what was settled. Rows of one source that share a key all
    stay. ``priority`` in the result tells the source a row came from.
    """
    if not sources:
        raise ValueError("at least one source is needed")
    key = columns(key)
    ranked = [df.withColumn("priority", F.lit(i)) for i, df in enumerate(sources)]
    union = reduce(DataFrame.unionByName, ranked)
    names = [*key, "priority", *(n for n in union.columns if n not in (*key, "priority"))]
    best = union.groupBy(*key).agg(F.min("priority").alias("priority"))
    # a null key is a key like any other
    settled = best.select(*(F.col(f"`{n}`").alias(f"_settled_{i}") for i, n in enumerate([*key, "priority"])))
    same = [F.col(f"`{n}`").eqNullSafe(F.col(f"_settled_{i}")) for i, n in enumerate([*key, "priority"])]
    return union.join(settled, same, "left_semi").select(*names)
