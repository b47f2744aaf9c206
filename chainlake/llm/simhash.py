"""SimHash near-duplicates by anchor-point covering.

A document's fingerprint is the bitwise majority of the hashes of its word shingles;
two link when their fingerprints differ in at most ``max_bits`` bits. To find all
links without comparing all pairs, the points of a covering code are anchors. Every
fingerprint is at home with its nearest anchor. Let ``x`` be the one of a linked pair
that is nearer to its home: then ``y`` is within its own distance plus ``max_bits`` of
that anchor. So each fingerprint is also a guest of every anchor that near, and
comparing the homes of each anchor with its guests loses no link. A fixed covering
radius would do in place of the own distance, but would make more guests.

The code is a product of random linear codes over equal blocks of bits, so anchors
near a fingerprint are put together from the nearest words of each block.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, forget, settle, text_batches, whole_row
from .components import components

SHINGLE, MAX_BITS, SEED = 3, 3, 42
#: Distinct fingerprints for each anchor that the code is chosen for.
PER_ANCHOR = 64
#: Bits of the largest code of one block.
BLOCK_BITS = 12

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Bits of every byte, most significant first.
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int32)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text; zero if it has no word."""
    words = WORD.findall(text.lower())  # of bytes: A-Z alone
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    last = min(shingle, len(words)) - 1
    stops = (ends[last:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip([0, *ends.tolist()], stops)]
    bytes_of = np.array(hashes, np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)
    ones = [np.bincount(bytes_of[:, i], minlength=256) @ BITS for i in range(8)]
    majority = np.concatenate(ones) * 2 > len(hashes)
    return int.from_bytes(np.packbits(majority).tobytes(), "big")


def fingerprint_of(text: F.Column, shingle: int = SHINGLE) -> F.Column:
    """The fingerprint of a text column as a signed long; null counts as empty."""

    def prints(texts: pa.Array) -> pa.Array:
        forget()
        found = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in texts]
        return pa.array(np.array(found, np.uint64).view(np.int64))

    return F.arrow_udf(prints, "long")(text.cast("string"))


class CoveringCode:
    """A product of random linear codes; random ones cover nearly as well as any.

    ``bits``: the binary logarithm of the number of anchors.
    """

    def __init__(self, bits: int):
        self.blocks = max(1, math.ceil(bits / BLOCK_BITS))
        rng = np.random.default_rng(7)
        edges = np.linspace(0, 64, self.blocks + 1).astype(int)
        self.shifts, self.widths = edges[:-1], np.diff(edges)
        self.words = []
        for block, width in enumerate(self.widths):
            words = np.zeros(1, np.uint64)
            for _ in range(bits // self.blocks + (block < bits % self.blocks)):
                words = np.concatenate([words, words ^ rng.integers(0, (1 << int(width)) - 1, dtype=np.uint64, endpoint=True)])
            self.words.append(np.unique(words))

    def near(self, prints: np.ndarray, slack: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in ``prints``, anchors, and whether the anchor is the home.

        All anchors within a print's own distance plus ``slack``.
        """
        place = np.arange(len(prints))
        anchor, over = np.zeros(len(prints), np.int64), np.zeros(len(prints), np.int64)
        for words, shift, width in zip(self.words, self.shifts, self.widths):
            part = (prints >> np.uint64(shift)) & np.uint64((1 << int(width)) - 1)
            distance = np.bitwise_count(part[:, None] ^ words[None, :])
            excess = distance - distance.min(axis=1, keepdims=True)
            which, word = np.nonzero(excess <= slack)
            more = excess[which, word].astype(np.int64)
            begins = np.searchsorted(which, np.arange(len(prints) + 1))
            counts = np.diff(begins)[place]
            to = np.repeat(np.arange(len(place)), counts)
            nth = np.arange(len(to)) - np.repeat(np.cumsum(counts) - counts, counts)
            row = begins[place[to]] + nth
            total = over[to] + more[row]
            keep = total <= slack
            to, row = to[keep], row[keep]
            place, anchor, over = place[to], anchor[to] * len(words) + word[row], total[keep]
        home = np.zeros(len(place), bool)
        nearest = np.flatnonzero(over == 0)
        _, first = np.unique(place[nearest], return_index=True)
        home[nearest[first]] = True
        return place, anchor, home


@lru_cache(maxsize=2)
def code_of(bits: int) -> CoveringCode:
    return CoveringCode(bits)


def link_fingerprints(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``a, b`` between the distinct longs ``prints.fp`` at most ``max_bits`` apart.

    Not every pair: of the links found at an anchor a spanning forest is kept, which
    has the same components and at most one link for each print there.
    """
    spark: SparkSession = prints.sparkSession
    total = prints.count()
    bits = max(6, math.ceil(math.log2(max(1, total / PER_ANCHOR))))

    def spread(batches: Iterator[dict]) -> Iterator[dict]:
        code = code_of(bits)
        for batch in batches:
            every = batch["fp"].to_numpy()
            for at in range(0, len(every), 512):
                own = every[at : at + 512]
                place, anchor, home = code.near(own.view(np.uint64), max_bits)
                yield {"anchor": anchor, "fp": own[place], "home": home}

    def compare(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = pa.Table.from_batches(list(tables))
        fp, home = group.column("fp").to_numpy(), group.column("home").to_numpy()
        links = spanning_links(fp[home], fp[~home], max_bits)
        yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], ["a", "b"])

    guests = arrow_rows(prints.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "fp"), spread, "anchor long, fp long, home boolean")
    return guests.groupBy("anchor").applyInArrow(compare, "a long, b long")


def spanning_links(homes: np.ndarray, guests: np.ndarray, max_bits: int) -> np.ndarray:
    """A spanning forest of the links among ``homes`` and from them to ``guests``."""
    every = np.concatenate([homes, guests])
    bits, parent, links = every.view(np.uint64), list(range(len(every))), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    rows = max(1, (4 << 20) // max(1, len(every)))
    for at in range(0, len(homes), rows):
        near = np.bitwise_count(bits[at : min(at + rows, len(homes)), None] ^ bits[None, :]) <= max_bits
        for i, j in zip(*(x.tolist() for x in np.nonzero(near))):
            a, b = root(i + at), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((every[i + at], every[j]))
    return np.array(links, np.int64).reshape(-1, 2)


def name_components(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fp, root, component_id`` of each distinct ``fp`` of stored ``fp, doc_id`` rows.

    ``root`` is one print of the component, ``component_id`` its smallest ``doc_id``.
    """
    firsts = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "firsts")
    roots = settle(components(link_fingerprints(firsts.select("fp"), max_bits)), "roots")
    rooted = firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return settle(rooted.join(least, "root").select("fp", "root", "component_id"), "names")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` that links lead to. Texts without a
    word, null ones too, have fingerprint zero and link like any other. Rows that
    repeat, or share a ``doc_id``, are one document number in the same component.
    Rows without a ``doc_id`` take part; a component of such rows alone has a null
    id. Other columns are not read.
    """
    text_batches(docs.sparkSession)
    prints = settle(docs.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprint_of(F.col("text"), shingle).alias("fp")), "prints")
    names = name_components(prints, max_bits)
    return prints.join(names, "fp").select("doc_id", "fp", "component_id")


def keep_one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component one stays.

    It has the smallest ``doc_id``; of rows that share it, one stays. In a component of
    rows without a ``doc_id`` one stays.
    """
    print_of = fingerprint_of(F.col("text"), shingle).alias("fp")
    numbered = docs.select(whole_row(docs), print_of, F.monotonically_increasing_id().alias("place"))
    stored = settle(numbered, "prints")
    rows = stored.select("fp", "place", F.col("row.doc_id").cast("long").alias("doc_id"))
    first = rows.join(name_components(rows, max_bits), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = first.groupBy("root").agg(F.min("place").alias("place"))
    return stored.join(kept, "place", "left_semi").select("row.*")
