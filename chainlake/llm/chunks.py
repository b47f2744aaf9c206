"""Documents stored in chunks that exchange names of their windows.

Operators on windows of text have more windows than Spark has any use to see as rows.
They keep documents in chunks of a few megabytes and let each chunk put its distinct
names (64-bit fingerprints) in order and send them, by leading bits, to buckets. A
bucket compares the names of all chunks and answers each with bits, one for each name
sent and in its order, so that an answer is a sixty-fourth of what was asked. However
common a name is, a bucket gets it once from each chunk.

Chunks are bucketed by their number, so answers come to them without moving text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainlake.session import scratch_dir

from .common import arrow_rows, power_of_two, release, settle, shuffle_partitions, text_batches

#: Bytes of text in a chunk (a longer document is one alone), and those that
#: one bucket of names is made for.
CHUNK, BUCKET = 2 << 20, 4 << 20


class Chunks:
    """``docs`` stored as ``chunk, docs`` with all columns of each row.

    Inside a chunk rows are in ascending order of ``doc_id``, null first. ``buckets``
    is the number of buckets for names.
    """

    def __init__(self, docs: DataFrame, chunk_bytes: int = CHUNK):
        spark = docs.sparkSession
        text_batches(spark)
        self.fields = docs.schema
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        least = shuffle_partitions(spark)
        self.buckets = power_of_two(max(least, size / BUCKET))
        schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("docs", T.ArrayType(self.fields))])
        name = f"chunks_{uuid.uuid4().hex}"
        packed = docs.mapInArrow(packer(chunk_bytes, schema), schema)
        writer = packed.write.bucketBy(int(max(least, size // (8 * chunk_bytes) + 1)), "chunk")
        writer.option("path", scratch_dir(spark, "chunks")).format("parquet").saveAsTable(name)
        self.table = spark.table(name)

    def with_rows(self, added: str = "") -> T.StructType:
        """A schema of ``row``, which is a whole row of the documents, and more columns."""
        more = T.StructType.fromDDL(added).fields if added else []
        return T.StructType([T.StructField("row", self.fields), *more])

    def map(self, fn: Callable[[dict, pa.StructArray], Iterator[dict] | list[dict]], schema, answers: list[DataFrame] = ()) -> DataFrame:
        """Rows that ``fn`` makes of each chunk: its number and answers, its documents."""
        met = self.table
        for answer in answers:
            met = met.join(answer, "chunk", "left")
        names = [c for c in met.columns if c != "docs"]

        def run(batches):
            for batch in batches:
                for i in range(len(batch["docs"])):
                    known = {n: batch[n][i].as_py() for n in names}
                    yield from fn(known, batch["docs"][i].values)

        return arrow_rows(met, run, schema)

    def ask(
        self, fn, decide, marks: tuple[str, ...], extras: dict[str, str], answers: list[DataFrame] = (), short: bool = False
    ) -> DataFrame:
        """Names sent to buckets and answered: ``chunk`` and one column for each mark.

        ``fn(known, docs)`` returns ordered distinct names and a dict of ``extras``
        (name: numpy type) beside them. ``decide(names, extras, chunk)`` gets the
        entries of a bucket, chunk after chunk, and returns a boolean array for each
        mark. A mark comes back as bits for :func:`unpack`. ``short`` sends only the 32
        bits after those that name the bucket; two names may then be taken for one.
        """
        shift = np.uint64(64 - (self.buckets.bit_length() - 1)) if self.buckets > 1 else None
        buckets, kind_of_name = self.buckets, np.uint32 if short else np.uint64

        def send(known, docs):
            names, beside = fn(known, docs)
            if not len(names):
                return
            bucket = names >> shift if shift is not None else np.zeros(len(names), np.uint64)
            cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
            full = np.flatnonzero(np.diff(cuts))
            if short:
                names = (names << np.uint64(buckets.bit_length() - 1) >> np.uint64(32)).astype(np.uint32)
            out = {"bucket": full, "chunk": np.full(len(full), known["chunk"]), "names": [names[cuts[b] : cuts[b + 1]].tobytes() for b in full]}
            for n, kind in extras.items():
                column = beside[n].astype(kind)
                out[n] = [column[cuts[b] : cuts[b + 1]].tobytes() for b in full]
            yield out

        def compare(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            group = pa.Table.from_batches(list(tables)).sort_by("chunk").combine_chunks()
            lengths = np.array([len(x.as_buffer()) // np.dtype(kind_of_name).itemsize for x in group.column("names")])
            read = lambda n, kind: np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in group.column(n)])
            chunk = np.repeat(np.arange(len(lengths)), lengths)
            found = decide(read("names", kind_of_name), {n: read(n, kind) for n, kind in extras.items()}, chunk)
            release()
            ends = np.cumsum(lengths)
            columns = [[np.packbits(x[e - k : e]).tobytes() for e, k in zip(ends, lengths)] for x in found]
            yield pa.RecordBatch.from_arrays(
                [group.column("chunk").combine_chunks(), group.column("bucket").combine_chunks(), pa.array(lengths), *(pa.array(c, pa.binary()) for c in columns)],
                ["chunk", "bucket", "n", *marks],
            )

        beside = "".join(f", {n} binary" for n in extras)
        sent = self.map(send, f"bucket int, chunk long, names binary{beside}", answers)
        columns = "".join(f", {m} binary" for m in marks)
        answered = sent.groupBy("bucket").applyInArrow(compare, f"chunk long, bucket int, n long{columns}")
        parts = F.array_sort(F.collect_list(F.struct("bucket", "n", *marks)))
        return settle(answered.groupBy("chunk").agg(parts.alias(marks[0] + "_parts")), marks[0])


def unpack(known: dict, first: str, mark: str) -> np.ndarray:
    """The bits of a mark, in the order of the names that the chunk sent."""
    parts = known.get(first + "_parts") or []
    bits = [np.unpackbits(np.frombuffer(p[mark], np.uint8), count=p["n"]) for p in parts]
    return np.concatenate(bits).astype(bool) if bits else np.zeros(0, bool)


def gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The batches of a task, put together until they have ``size`` bytes."""
    some: list[pa.RecordBatch] = []
    for batch in batches:
        some.append(batch)
        if sum(b.nbytes for b in some) >= size:
            yield pa.concat_batches(some)
            some = []
    if sum(map(len, some)):
        yield pa.concat_batches(some)


def packer(chunk_bytes: int, schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    rows = arrow.field("docs").type.value_type

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in gathered(batches, 4 * chunk_bytes):
            ids = batch.column(batch.schema.names.index("doc_id"))
            batch = batch.take(pa.compute.sort_indices(ids, null_placement="at_start"))
            text = batch.column(batch.schema.names.index("text"))
            size = np.cumsum(pa.compute.binary_length(text).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            cuts = [0]
            while cuts[-1] < len(size):
                done = size[cuts[-1] - 1] if cuts[-1] else 0
                cuts.append(max(cuts[-1] + 1, int(np.searchsorted(size, done + chunk_bytes, "right"))))
            fields = [c if c.type == f.type else c.cast(f.type) for c, f in zip(batch.columns, rows)]
            struct = pa.StructArray.from_arrays(fields, fields=list(rows))
            lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), struct)
            chunk = pa.array(number + np.arange(len(cuts) - 1))
            number += len(cuts) - 1
            yield pa.RecordBatch.from_arrays([chunk, lists.cast(arrow.field("docs").type)], schema=arrow)

    return pack


def column_of(docs: pa.StructArray, name: str) -> pa.Array:
    index = docs.type.get_field_index(name)
    return docs.flatten()[index]


def same_as_next(*columns: np.ndarray) -> np.ndarray:
    """Whether an entry equals the one after it."""
    same = np.ones(max(0, len(columns[0]) - 1), bool)
    for c in columns:
        same &= c[1:] == c[:-1]
    return same


def elsewhere(names: np.ndarray, extras: dict, chunk: np.ndarray) -> list[np.ndarray]:
    """Whether another chunk has sent the name, its ``low`` bits too."""
    order = np.lexsort((extras["low"], names)) if "low" in extras else np.argsort(names, kind="stable")
    same = same_as_next(names[order], *(extras[n][order] for n in extras if n == "low"))
    found = np.zeros(len(names), bool)
    found[order[1:]] |= same
    found[order[:-1]] |= same
    return [found]


def covered(starts: np.ndarray, length: int, size: int) -> np.ndarray:
    """Places that runs of ``length`` from ``starts`` cover."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + length, -1)
    return np.cumsum(change)[:-1] > 0
