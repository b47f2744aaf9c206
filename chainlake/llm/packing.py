"""Best-fit packing planned over a histogram of lengths.

Documents are encoded, closed by an end id and cut at ``capacity``. Their lengths
are counted, and best fit runs over the counts: at most ``capacity`` lengths, each
placed for many sequences at once, so planning takes the same time for a thousand
documents as for a billion. The plan says which slots the documents of one length
take; a document finds its own by its rank within that length. Ranks are numbered
in each task while pieces are written and moved up by the counts of the tasks
before it, so no length, however common, is gathered anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_rows, document_texts, settle
from .encode import closed, encoder

CAPACITY = 4096
END_ID = 1

#: Texts encoded together.
BATCH = 1_000


def encode_pieces(
    docs: DataFrame, path: str, cut: str = "words", end_id: int = END_ID, capacity: int = CAPACITY
) -> DataFrame:
    """Pieces of all documents: ``doc_id, piece, start, length, ids, part, place``.

    ``ids`` holds little-endian unsigned 32-bit integers. ``part`` is the task that
    wrote the piece and ``place`` its rank among the pieces of its length there.
    A null or empty text is its end id alone.
    """

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        tokens, part = encoder(path, cut), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for at in range(0, len(batch["doc_id"]), BATCH):
                keys = batch["doc_id"].slice(at, BATCH).to_pylist()
                ids, sizes = closed(*tokens.encode_all(batch["text"].slice(at, BATCH)), end_id)
                raw, begin = memoryview(ids.tobytes()), 0
                out = {n: [] for n in ("doc_id", "piece", "start", "length", "ids", "place")}
                for key, size in zip(keys, sizes.tolist()):
                    for piece, start in enumerate(range(0, size, capacity)):
                        length = min(capacity, size - start)
                        own = bytes(raw[4 * (begin + start) : 4 * (begin + start + length)])
                        for column, value in zip(out.values(), (key, piece, start, length, own, int(seen[length]))):
                            column.append(value)
                        seen[length] += 1
                    begin += size
                yield out | {"part": [part] * len(out["doc_id"])}

    schema = "doc_id long, piece int, start long, length long, ids binary, part int, place long"
    return arrow_rows(document_texts(docs), run, schema, keep=True)


def plan_best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, ...]]:
    """Best fit, longest first, over counts instead of documents.

    Rows ``(length, first_rank, sequences, each, sequence, offset)``: from rank
    ``first_rank`` on, the pieces of ``length`` fill ``sequences`` sequences that
    begin with number ``sequence``, ``each`` of them side by side from ``offset``.

    Open sequences stand in groups of equal free room. A length goes to the group
    with the least room that holds it, as often as it fits, exactly where best fit
    puts one document after the other. A step uses up a length or a group, so there
    are at most about two per length.
    """
    free: dict[int, list[list[int]]] = {}  # room: runs [first sequence, sequences]
    opened, plan = 0, []
    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        left, rank = counts[length], 0
        moved: list[tuple[int, int, int]] = []

        def put(sequence: int, sequences: int, each: int, room: int, rank: int) -> None:
            plan.append((length, rank, sequences, each, sequence, capacity - room))
            moved.append((room - each * length, sequence, sequences))

        for room in sorted(r for r in free if r >= length):
            runs = free[room]
            while runs and left:
                sequence, sequences = runs.pop()
                each = min(room // length, left)
                full = min(sequences, left // each)
                if full < sequences:
                    runs.append([sequence + full, sequences - full])
                put(sequence, full, each, room, rank)
                left, rank = left - full * each, rank + full * each
            if not runs:
                del free[room]
            if not left:
                break
        while left:
            each = min(capacity // length, left)
            full = left // each
            put(opened, full, each, capacity, rank)
            opened, left, rank = opened + full, left - full * each, rank + full * each
        for room, sequence, sequences in moved:
            if room:
                free.setdefault(room, []).append([sequence, sequences])
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give each piece its ``sequence_id`` and ``offset``.

    ``pieces`` must be stored, as its rows are read twice, with ``part``, ``place``
    and ``length`` as :func:`encode_pieces` numbers them. All other columns stay.
    Equal pieces are packed one by one; no pieces give no rows.

    The histogram that reaches the driver has at most ``capacity`` rows. The plan
    has a few rows per length, too, and goes to the tasks in their closure.
    """
    part_counts = pieces.groupBy("length", "part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = part_counts.select(
        "length", "part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    histogram = {r["length"]: r["n"] for r in part_counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    plan = np.array(plan_best_fit(histogram, capacity), np.int64).reshape(-1, 6)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, firsts = plan[:, 0], plan[:, 1]
        bases = np.searchsorted(lengths, np.arange(capacity + 2))
        for batch in batches:
            length, rank = (batch.column(n).to_numpy() for n in ("length", "_rank"))
            row = np.empty(len(length), np.int64)
            for n in np.unique(length):
                own = length == n
                row[own] = bases[n] + np.searchsorted(firsts[bases[n] : bases[n + 1]], rank[own], "right") - 1
            _, first, _, each, sequence, offset = plan[row].T
            nth = rank - first
            names = [n for n in batch.schema.names if n != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sequence + nth // each), pa.array(offset + nth % each * length)],
                [*names, "sequence_id", "offset"],
            )

    ranked = pieces.join(firsts, ["length", "part"]).withColumn("_rank", F.col("place") + F.col("_before"))
    ranked = ranked.drop("_before", "part", "place")
    ranked = ranked.select("doc_id", "piece", *(c for c in ranked.columns if c not in ("doc_id", "piece")))
    schema = ranked.drop("_rank").schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(slots, schema)


def pack_documents(
    docs: DataFrame, path: str, cut: str = "words", end_id: int = END_ID, capacity: int = CAPACITY, ids: bool = True
) -> DataFrame:
    """Encode, cut and pack whole documents.

    Returns ``doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset``; without
    ``ids`` these stay in the stored pieces and out of the shuffle that ranks them.
    Null and empty texts are their end id alone; rows that repeat, or share or lack
    a ``doc_id``, are documents of their own; no documents give no rows. Columns
    besides ``doc_id`` and ``text`` are not read.
    """
    pieces = encode_pieces(docs, path, cut, end_id, capacity).withColumn("ids_crc32", F.crc32("ids"))
    stored = settle(pieces, "pieces")
    return pack(stored if ids else stored.drop("ids"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, length, ids``.

    A group holds ``capacity`` ids at most.
    """
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(inside, F.lit(b""), lambda done, x: F.concat(done, x["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
