"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import io
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainlake.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: a lost executor costs the tasks it ran and no more, and
    rows whose numbering depends on task order stay as they were written.
    """
    return settled(df, label)[0]


def settled(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """:func:`settle` with the folder, for :func:`drop_folder`."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of :func:`settled` that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


#: Texts that go to Python together; Spark's own limit would make batches of tens of MB.
TEXTS_PER_BATCH = 1_000


def text_batches(spark: SparkSession) -> None:
    """Keep batches of texts small from now on; a lower limit of the session stays.

    Spark reads the limit when a query runs, so it has to be the session's.
    """
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(limit)) <= TEXTS_PER_BATCH:
        spark.conf.set(limit, str(TEXTS_PER_BATCH))


def document_texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone; a null text becomes an empty one."""
    text_batches(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def whole_row(docs: DataFrame) -> F.Column:
    """All columns of a row as one, ``row``, so that no name can clash with a result's."""
    text_batches(docs.sparkSession)
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")


def text_of() -> F.Column:
    """The text of a ``row``, empty if null."""
    return F.coalesce(F.col("row.text").cast("string"), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(divisor: int) -> F.Column:
    """Remainder of the CRC-32 of the decimal ``doc_id``; null ids give null."""
    return F.crc32(F.col("doc_id").cast("string")) % divisor


#: What a Python worker keeps from task to task.
MEMORIES: list[dict] = []


def forget() -> None:
    """Empty the memories: a worker that turns to another operator needs the room."""
    for memory in MEMORIES:
        memory.clear()


def release() -> None:
    """Give freed memory back to the system; a worker that waits would keep it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # only some C libraries have it
        ctypes.CDLL(None).malloc_trim(0)


def arrow_rows(
    df: DataFrame, fn: Callable[[Iterator[dict]], Iterable[dict]], schema: str, keep: bool = False
) -> DataFrame:
    """Run ``fn`` over the batches of a partition as dicts of Arrow columns.

    ``fn`` yields dicts of column values; Python lists, numpy and Arrow arrays do.
    With ``keep`` the worker's memories stay.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keep:
            forget()
        columns = ({n: b.column(i) for i, n in enumerate(b.schema.names)} for b in batches)
        for out in fn(columns):
            arrays = [
                out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], type=f.type)
                for f in arrow
            ]
            arrays = [a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, arrow)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
        release()

    return df.mapInArrow(run, fields)


def together(rows: Iterable[dict], weight: Callable[[dict], int] = lambda row: 0, most: int = 4 << 20) -> Iterator[dict]:
    """Rows as dicts of lists: a thousand rows, or less once their ``weight`` is ``most``."""
    some: list[dict] = []
    heavy = 0
    for row in rows:
        some.append(row)
        heavy += weight(row)
        if len(some) == TEXTS_PER_BATCH or heavy >= most:
            yield {c: [r[c] for r in some] for c in row}
            some, heavy = [], 0
    if some:
        yield {c: [r[c] for r in some] for c in some[0]}


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column, one behind the other, and ``len + 1`` offsets.

    Null strings count as empty. Nothing is copied unless there are nulls.
    """
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    first, last = int(offsets[0]), int(offsets[-1])
    raw = np.frombuffer(data, np.uint8)[first:last] if data is not None and last > first else np.zeros(0, np.uint8)
    return raw, offsets - first


def power_of_two(at_least: float) -> int:
    return 1 << max(0, math.ceil(math.log2(max(1.0, at_least))))


def save(arrays: list[np.ndarray]) -> bytes:
    """Arrays one behind the other, each with its type and shape."""
    out = io.BytesIO()
    for array in arrays:
        np.save(out, array)
    return out.getvalue()


def load(raw: bytes) -> list[np.ndarray]:
    """The arrays that :func:`save` wrote."""
    source, arrays = io.BytesIO(raw), []
    while source.tell() < len(raw):
        arrays.append(np.load(source))
    return arrays
