"""Vectors as short codes: product quantisation by Lloyd rounds over active entries.

Components become integers, vectors are cut into parts, and each place of a part has its
codebook. A round assigns every part to the nearest entry of its codebook and moves the
entries to the means of their parts. All is integer arithmetic, so results are exact and
don't depend on how rows are dealt.

Every part keeps its entry and its exact distance to it. While that entry stays fixed, only
entries that moved can have come nearer: the others were farther in the round before, or as
far and of a higher index, and still are. So such parts compare the moved entries alone with
the stored distance; parts whose own entry moved look at all entries.

A round is one pass over a stored table: rows are read, assigned and written again with
their state, and each task adds one row of sums, from which the codebooks (bounded by their
size, not by the data) are made. The table of the round before is then deleted. Integers are
stored as narrow as a row allows.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, drop_folder, settle, settled, utf8

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Integers below this go the fast way: their squared distances fit in 64 bits for parts of
#: up to 8,192 components. Rows beyond it are computed with Python's integers.
NARROW = 1 << 24
#: Totals are shuffled in limbs of so many bits.
LIMB = 60
LONGEST = (1 << 63) - 1

STATE = "vec_id long, label {label}, size int, ints binary, codes binary, distances binary, sums array<struct<part:int,entry:int,place:int,limb:int,total:bigint>>"


@dataclass
class Codes:
    """``rows``: ``vec_id, label, code, error``; ``codebooks``: part, entry, component."""

    rows: DataFrame
    codebooks: list[list[list[int]]]

    def digest(self) -> str:
        """SHA-256 of all components in decimal, joined by commas."""
        return hashlib.sha256(",".join(str(x) for book in self.codebooks for e in book for x in e).encode()).hexdigest()


def usable(vector: Column) -> Column:
    """Whether a vector is there and has finite components alone."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite


def integers(values: np.ndarray, scale: int) -> list[int]:
    """``floor(scale * x)`` without rounding, however large."""
    return [math.floor(Fraction(x) * scale) for x in values.tolist()]


def to_integers(vectors: pa.Array, scale: int) -> list[bytes]:
    """Each row's integers in 16 or 32 bits, or, where those are not narrow, its doubles."""
    offsets = vectors.offsets.to_numpy() - vectors.offsets[0].as_py() if len(vectors) else np.zeros(1, int)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        scaled = np.floor(values * scale)  # exact below NARROW if scale is a power of two
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        most = np.abs(scaled[a:b]).max(initial=0)
        kind = "<i2" if most < 1 << 15 else "<i4" if most < NARROW else None
        out.append(scaled[a:b].astype(kind).tobytes() if kind else values[a:b].astype("<f8").tobytes())
    return out


def matrices(ints: pa.Array, dimension: int, padded: int, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and integer rows (of 64 bits or of Python) of all rows of one width."""
    raw, offsets = utf8(ints)
    widths = np.diff(offsets)
    for width in np.unique(widths).tolist():
        at = np.flatnonzero(widths == width)
        own = raw[offsets[at][:, None] + np.arange(width)] if dimension else np.zeros((len(at), 0), np.uint8)
        wide = dimension and width == 8 * dimension
        rows = np.zeros((len(at), padded), object if wide else np.int64)
        if wide:
            for i, row in enumerate(own):
                rows[i, :dimension] = integers(row.view("<f8"), scale)
        elif dimension:
            rows[:, :dimension] = own.view("<i2" if width == 2 * dimension else "<i4")
        yield at, rows


def distances(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of each row to each entry."""
    kind = object if object in (rows.dtype, entries.dtype) else np.int64
    total = np.zeros((len(rows), len(entries)), kind)
    for c in range(rows.shape[1]):
        total += (rows[:, c, None].astype(kind) - entries[None, :, c].astype(kind)) ** 2
    return total


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row, the lower index of equals, and its distance."""
    found = distances(rows, entries)
    code = found.argmin(axis=1)
    return code, found[np.arange(len(rows)), code]


def reassign(rows: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`nearest` from the entries and distances of the round before.

    ``known`` is negative where no distance is stored.
    """
    code, known = code.copy(), known.copy()
    active = np.flatnonzero(moved)
    whole = moved[code] | (known < 0)
    at = np.flatnonzero(whole)
    if len(at):
        code[at], known[at] = nearest(rows[at], entries)
    at = np.flatnonzero(~whole)
    if len(at) and len(active):
        best, length = nearest(rows[at], entries[active])
        best = active[best]
        closer = (length < known[at]) | (length == known[at]) & (best < code[at])
        code[at[closer]], known[at[closer]] = best[closer], length[closer]
    return code, known


def as_arrays(codebooks: list) -> list[np.ndarray]:
    """Codebooks as arrays of 64 bits where that is safe, else of Python's integers."""
    books = []
    for book in codebooks:
        narrow = all(-NARROW < x < NARROW for e in book for x in e)
        books.append(np.array(book, np.int64 if narrow else object).reshape(len(book), len(book[0]) if book else 0))
    return books


def limbs(total: int) -> Iterator[tuple[int, int]]:
    """A total as signed limbs; the sum of limbs of many totals is that of the totals."""
    number = 0
    while total and not -(1 << 62) < total < 1 << 62:
        total, low = divmod(total, 1 << LIMB)
        yield number, low
        number += 1
    if total:
        yield number, total


def one_round(state: DataFrame, codebooks: list, moved: list[list[bool]], dimension: int, scale: int) -> DataFrame:
    """All rows assigned, and a row of sums from each task."""
    books, active = as_arrays(codebooks), [np.array(m, bool) for m in moved]
    parts, width = len(books), -(-dimension // len(books))

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        totals: Counter = Counter()
        for batch in batches:
            n = len(batch["ints"])
            code, length = np.zeros((n, parts), np.uint8), np.full((n, parts), -1, np.int64)
            old = batch["codes"].null_count < n
            if old:
                before = utf8(batch["codes"])[0].reshape(n, parts).astype(np.int64)
                known = utf8(batch["distances"])[0].view("<i8").reshape(n, parts)
            for at, rows in matrices(batch["ints"], dimension, parts * width, scale):
                for p in range(parts):
                    own = rows[:, p * width : (p + 1) * width]
                    exact = object not in (own.dtype, books[p].dtype)
                    if old and exact:
                        code[at, p], length[at, p] = reassign(own, books[p], active[p], before[at, p], known[at, p])
                    else:
                        code[at, p], found = nearest(own, books[p])
                        length[at, p] = found if exact else -1
                    add(totals, p, code[at, p], own, len(books[p]))
            out = {c: batch[c] for c in ("vec_id", "label", "size", "ints")}
            yield out | {"codes": rows_of(code), "distances": rows_of(length), "sums": pa.nulls(n)}
        sums = [{"part": p, "entry": e, "place": c, "limb": i, "total": x} for (p, e, c), t in totals.items() for i, x in limbs(t)]
        yield {c: [None] for c in ("vec_id", "label", "size", "ints", "codes", "distances")} | {"sums": [sums]}

    return arrow_rows(state.where("sums is null"), run, state.schema)


def rows_of(array: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in np.ascontiguousarray(array)]


def add(totals: Counter, part: int, code: np.ndarray, rows: np.ndarray, entries: int) -> None:
    """Add the rows of each entry up; place -1 counts them."""
    for e in range(entries):
        own = rows[code == e]
        if len(own):
            totals[part, e, -1] += len(own)
            for c, total in enumerate(own.sum(axis=0).tolist()):
                totals[part, e, c] += int(total)


def moved_entries(state: DataFrame, codebooks: list) -> tuple[list, list[list[bool]]]:
    """Codebooks with every used entry at the floor of its parts' mean, and which changed."""
    sums = state.where("sums is not null").select(F.inline("sums")).groupBy("part", "entry", "place", "limb")
    totals: Counter = Counter()
    for r in sums.agg(F.sum(F.col("total").cast("decimal(19,0)")).alias("total")).collect():
        totals[r["part"], r["entry"], r["place"]] += int(r["total"]) << (LIMB * r["limb"])
    new = [
        [[totals[p, e, c] // n for c in range(len(entry))] if (n := totals[p, e, -1]) else entry for e, entry in enumerate(book)]
        for p, book in enumerate(codebooks)
    ]
    return new, [[a != b for a, b in zip(*books)] for books in zip(new, codebooks)]


def first_codebooks(vectors: DataFrame, dimension: int, parts: int, entries: int, scale: int) -> list:
    """The parts of the rows of the smallest ids."""
    rows = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "ints").select("ints").limit(entries).collect()
    width = -(-dimension // parts)
    books: list = [[] for _ in range(parts)]
    for r in rows:
        for _, matrix in matrices(pa.array([bytes(r["ints"])], pa.binary()), dimension, parts * width, scale):
            row = matrix[0].tolist()
            for p in range(parts):
                books[p].append(row[p * width : (p + 1) * width])
    return books


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codes:
    """Codes of all usable rows of ``vec_id, embedding, label``.

    Rows whose vector is null or holds null or non-finite components take no part, nor do
    rows of another length than most have (of equally many, the longer). A length that
    ``parts`` doesn't divide is filled up with zeros. Fewer rows than ``entries`` make shorter
    codebooks. Rows of one ``vec_id`` are rows of their own; for the first entries they, and
    rows without an id, which come last, are in the order of their integers. ``error`` is the
    squared distance over all parts, null beyond 64 bits. ``entries`` is at most 256, ``scale``
    a power of two. Other columns are not read.
    """
    if not 0 < entries <= 256 or parts < 1 or scale & (scale - 1):
        raise ValueError("entries must be 1 to 256, parts at least 1, scale a power of two")
    vector = F.col("embedding").cast("array<double>") if "double" in vectors.schema["embedding"].dataType.simpleString() else F.col("embedding").cast("array<float>")
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", vector.alias("embedding")).where(usable(F.col("embedding")))
    schema = STATE.format(label=vectors.schema["label"].dataType.simpleString())

    def store(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            n, vectors = len(batch["embedding"]), batch["embedding"]
            sizes = np.diff(vectors.offsets.to_numpy())
            nothing = {c: pa.nulls(n) for c in ("codes", "distances", "sums")}
            yield {"vec_id": batch["vec_id"], "label": batch["label"], "size": sizes, "ints": to_integers(vectors, scale)} | nothing

    state, folder = settled(arrow_rows(kept, store, schema), "vectors")
    most = state.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()
    dimension = most["size"] if most else 0
    state = state.where((F.col("size") == dimension) | F.col("sums").isNotNull())
    codebooks = first_codebooks(state, dimension, parts, entries, scale)
    moved = [[True] * len(book) for book in codebooks]
    for i in range(rounds + 1 if most else 0):
        state, new = settled(one_round(state, codebooks, moved, dimension, scale), "vectors")
        drop_folder(state.sparkSession, folder)
        folder = new
        if i < rounds:
            codebooks, moved = moved_entries(state, codebooks)
    final = settle(errors(state.where("sums is null"), codebooks, dimension, scale), "codes")
    drop_folder(state.sparkSession, folder)
    return Codes(final, codebooks)


def errors(state: DataFrame, codebooks: list, dimension: int, scale: int) -> DataFrame:
    """``vec_id, label, code, error`` of assigned rows."""
    books, parts = as_arrays(codebooks), len(codebooks)
    width = -(-dimension // parts)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            n = len(batch["codes"])
            code = utf8(batch["codes"])[0].reshape(n, parts)
            known = utf8(batch["distances"])[0].view("<i8").reshape(n, parts)
            error = [sum(row) if min(row) >= 0 else None for row in known.tolist()]
            again = np.array([e is None for e in error])
            for at, rows in matrices(batch["ints"].filter(pa.array(again)), dimension, parts * width, scale) if again.any() else ():
                for i, row in zip(np.flatnonzero(again)[at], rows):
                    whole = [x for p, c in enumerate(code[i]) for x in books[p][c].tolist()]
                    error[i] = sum((int(x) - int(y)) ** 2 for x, y in zip(row.tolist(), whole))
            error = [e if e <= LONGEST else None for e in error]
            yield {"vec_id": batch["vec_id"], "label": batch["label"], "code": [c.tobytes().hex() for c in code], "error": error}

    label = state.schema["label"].dataType.simpleString()
    return arrow_rows(state, run, f"vec_id long, label {label}, code string, error long")


def decode(codes: DataFrame, codebooks: list, scale: int = SCALE) -> DataFrame:
    """``codes`` with ``decoded``, the doubles that ``code`` stands for."""
    entries = F.lit([[[x / scale for x in e] for e in book] for book in codebooks])
    hexed = lambda p: F.conv(F.substr("code", F.lit(2 * p + 1), F.lit(2)), 16, 10).cast("int")
    return codes.withColumn("decoded", F.concat(*(entries[p][hexed(p)] for p in range(len(codebooks)))))


def with_label_errors(rows: DataFrame) -> DataFrame:
    """``rows`` with ``label_error``, the sum of ``error`` over equal labels, nulls together.

    Null where an error of the label is null or the sum needs more than 64 bits.
    """
    total = F.sum(F.col("error").cast("decimal(19,0)"))
    total = F.when((F.count("*") == F.count("error")) & (total <= LONGEST), total).cast("long")
    totals = rows.groupBy(F.col("label").alias("of_label")).agg(total.alias("label_error"))
    return rows.join(totals, F.col("label").eqNullSafe(F.col("of_label")), "left").drop("of_label")
