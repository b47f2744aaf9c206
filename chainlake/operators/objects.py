"""Byte objects kept as chunks: offsets and fixed-size parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import columns, whole

#: Chunks that share one window group. It bounds the group of a huge object.
OFFSET_SPAN = 4096


def cut(data: Column, size: int) -> Column:
    """Array of consecutive slices of ``size`` bytes, the last one shorter."""
    length = F.octet_length(data)
    starts = F.when(length > 0, F.sequence(F.lit(0), whole(length - 1, F.lit(size)).cast("int")))
    return F.transform(
        F.coalesce(starts, F.array().cast("array<int>")),
        lambda i: F.substring(data, i * F.lit(size) + 1, F.lit(size)),
    )


def chunk_offsets(
    chunks: DataFrame, key: str | Sequence[str] = "object_id", span: int = OFFSET_SPAN
) -> DataFrame:
    """``key, chunk_no, length, offset`` of each chunk, from metadata only.

    The running sum has two levels, so that no object has to fit in one task:
    inside spans of ``span`` chunk numbers, then over the span totals. A
    ``length`` column is used where the table has one; the scan then leaves the
    bytes alone. Both levels read the same shuffled metadata.
    """
    key = columns(key)
    length = F.col("length") if "length" in chunks.columns else F.octet_length("data")
    # A span that is never null keeps the optimizer from adding a filter to one
    # of the two readers only, which would stop them from sharing the shuffle.
    meta = chunks.select(
        *key,
        "chunk_no",
        length.cast("long").alias("length"),
        F.coalesce(whole(F.col("chunk_no"), F.lit(span)), F.lit(0)).alias("_span"),
    ).repartition(*key, "_span")

    before = Window.rowsBetween  # frames end before the current row
    in_span = before(Window.unboundedPreceding, -1).partitionBy(*key, "_span").orderBy("chunk_no")
    over_spans = before(Window.unboundedPreceding, -1).partitionBy(*key).orderBy("_first")
    bases = (
        meta.groupBy(*key, "_span")
        .agg(F.sum("length").alias("_total"), F.min("chunk_no").alias("_first"))
        .select(
            *key,
            "_span",
            F.coalesce(F.sum("_total").over(over_spans), F.lit(0)).alias("_base"),
        )
    )
    number = F.col("chunk_no")
    by_number = Window.partitionBy(*key, "_span").orderBy("chunk_no")
    name = F.concat_ws(":", *key, "chunk_no")
    again = F.raise_error(F.concat(F.lit("chunk number occurs twice: "), name)).cast("long")
    twice = F.lag(number).over(by_number) == number
    inside = meta.withColumn(
        "_inside",
        F.when(twice, again).otherwise(F.coalesce(F.sum("length").over(in_span), F.lit(0))),
    )
    return inside.join(bases, [*key, "_span"]).select(
        *key, "chunk_no", "length", (F.col("_base") + F.col("_inside")).alias("offset")
    )


def rechunk(
    chunks: DataFrame,
    part_size: int,
    key: str | Sequence[str] = "object_id",
    span: int = OFFSET_SPAN,
) -> DataFrame:
    """``key, part_no, data``: parts of exactly ``part_size``, the last shorter.

    The result depends on the bytes and ``part_size`` alone. A chunk may span
    several parts and a part several chunks; slices meet again in groups of
    (object, part), each bounded by ``part_size`` and never a whole object. An
    empty object has no parts.

    Chunks that carry their ``offset`` skip the offset join, so their bytes are
    shuffled once and not twice. Where all chunks but an object's last have one
    length, the offset is ``chunk_no`` times that length. Given offsets are
    checked: inside a part every slice must begin where the one before it ends, the
    first at the part's own begin, or the job fails. That a part is missing or ends
    early shows in :func:`~chainlake.operators.integrity.composite_etag`. A chunk
    number that occurs twice fails the job, too.
    """
    if part_size < 1:
        raise ValueError("part_size must be positive")
    key = columns(key)
    given = "offset" in chunks.columns
    located = chunks
    if not given:
        offsets = chunk_offsets(chunks, key, span)
        located = chunks.drop("length").join(offsets, [*key, "chunk_no"])
    length = F.octet_length("data").cast("long")
    size = F.lit(part_size).cast("long")

    def slice_of(part: Column) -> Column:
        start = F.greatest(part * size - F.col("offset"), F.lit(0).cast("long"))
        stop = F.least((part + 1) * size - F.col("offset"), length)
        return F.struct(
            part.alias("part_no"),
            (F.col("offset") + start).alias("_at"),
            F.substring("data", (start + 1).cast("int"), (stop - start).cast("int")).alias("_slice"),
        )

    first = whole(F.col("offset"), size)
    last = whole(F.col("offset") + length - 1, size)
    slices = (
        located.filter(length > 0)
        .select(*key, F.inline(F.transform(F.sequence(first, last), slice_of)))
        # Spread by part even where the rows already lie together by object.
        .repartition(*key, "part_no")
    )
    joined = [F.expr("listagg(_slice) WITHIN GROUP (ORDER BY _at)").alias("data")]
    data = F.col("data")
    if given:
        seam = F.struct("_at", F.octet_length("_slice").cast("long").alias("_length"))
        joined.append(F.collect_list(seam).alias("_seams"))
        ends = F.aggregate(
            F.array_sort("_seams"),
            F.col("part_no") * size,
            lambda due, s: F.when(s["_at"] == due, due + s["_length"]).otherwise(-1),
        )
        name = F.concat_ws(":", *key, "part_no")
        broken = F.raise_error(F.concat(F.lit("gap or overlap in part "), name)).cast("binary")
        data = F.when(ends >= 0, data).otherwise(broken)
    parts = slices.groupBy(*key, "part_no").agg(*joined)
    return parts.select(*key, "part_no", data.alias("data"))
