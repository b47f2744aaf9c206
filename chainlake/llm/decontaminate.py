"""Benchmark decontamination by greedy string tiling.

Documents and test items are words, case-folded, without what is no letter or digit of
any alphabet. In scripts without blanks each character is a word.
Runs of ``match`` words that a document shares with an item are seeds; documents join
items on them. Where seeds meet, the longest common run of words that isn't marked yet
is marked as a tile in both, again and again, until none of ``match`` words is left.
Runs are found by rolling fingerprints (Karp-Rabin) and confirmed on the words. The
share of an item under tiles does not depend on their order, so reordered passages
count as whole ones.

Test items go to the tasks in blocks of a bounded number of seeds, a few blocks at a
time; every document meets every block, whatever its length and however many documents
share an item.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import BASE, BYTE_VALUES, LOWER, WORD_BYTES, Rolling, finish, slabs, word_hashes
from .common import forget, settle, text_of, whole_row

#: Words of the shortest tile; share of an item under tiles that makes a leak.
MATCH, COVERAGE = 5, 0.4
#: Seeds of one block of items, 24 bytes each, and blocks that a task holds at once.
BLOCK_SEEDS, AT_ONCE = 500_000, 4


#: Characters that show nothing and split no word.
UNSEEN = re.compile("[\u00ad\u200c\u200d\u2060\ufeff\ufe00-\ufe0f]")
#: Scripts without blanks: Thai and Lao, Myanmar, Khmer, Tai and Lanna, kana and bopomofo,
#: Chinese characters, Yi, Javanese.
UNSPACED = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F),
    (0x3005, 0x3007), (0x3021, 0x3029), (0x3040, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF),
    (0x4E00, 0xA4CF), (0xA980, 0xA9FF), (0xAA60, 0xAA7F), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B2FF), (0x20000, 0x3FFFF),
)


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """For each character: 0 if it parts words, 1 in a word, 2 as a word of its own.

    Marks belong to the letters before them; what no alphabet has yet counts as a letter.
    """
    kind = np.ones(0x110000, np.uint8)
    kind[:0x33500] = [unicodedata.category(chr(c)) in WORD_CATEGORIES for c in range(0x33500)]
    for first, last in UNSPACED:
        kind[first : last + 1] *= 2
    return kind


WORD_CATEGORIES = {"Lu", "Ll", "Lt", "Lm", "Lo", "Mn", "Mc", "Me", "Nd", "Nl", "No", "Co", "Cn"}


def folded(text: bytes) -> str:
    """A text so that upper and small letters, in any composition, are the same."""
    normal = unicodedata.normalize("NFC", text.decode("utf-8", "replace")).casefold()
    return UNSEEN.sub("", unicodedata.normalize("NFC", normal))


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word fingerprints and the text of each."""
    if not len(raw) or raw.max() < 128:
        hashes, doc, _, _ = word_hashes(LOWER[raw], offsets, WORD_BYTES)
        return hashes, doc
    data = raw.tobytes()
    texts = [folded(data[a:b]) for a, b in zip(offsets, offsets[1:])]
    offsets = np.cumsum([0, *map(len, texts)])
    chars = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
    kind = np.append(kinds()[chars], 0)
    begins = np.zeros(len(kind), bool)  # of documents
    begins[offsets] = True
    before = np.append(0, kind[:-1])
    starts = np.flatnonzero((kind == 2) | (kind == 1) & ((before != 1) | begins))
    stops = np.flatnonzero((before == 2) | (before == 1) & ((kind != 1) | begins))
    doc = np.searchsorted(offsets, starts, "right") - 1
    return Rolling(values_of(chars)).runs(starts, stops), doc


def values_of(chars: np.ndarray) -> np.ndarray:
    """A number for each character; those of ASCII are the ones of :mod:`arrays`."""
    values = finish((chars.astype(np.uint64) + np.uint64(1)) * np.uint64(BASE))
    ascii_ = chars < 128
    values[ascii_] = BYTE_VALUES[chars[ascii_]]
    return values


def seeds_of(words: np.ndarray, match: int) -> np.ndarray:
    return Rolling(words).windows(match)


class Items:
    """Some test items, and where each seed is in them."""

    def __init__(self, rows: list[tuple[int, bytes]], match: int):
        self.match = match
        self.ids = [r[0] for r in rows]
        raw = np.frombuffer(b"".join(r[1] for r in rows), np.uint8)
        offsets = np.cumsum([0, *(len(r[1]) for r in rows)])
        words, item = tokens(raw, offsets)
        bounds = np.searchsorted(item, np.arange(len(rows) + 1))
        self.words = [words[a:b] for a, b in zip(bounds, bounds[1:])]
        # an item shorter than a seed is one seed as a whole
        self.short: dict[int, list[int]] = defaultdict(list)
        for i, w in enumerate(self.words):
            if 0 < len(w) < match:
                self.short[int(seeds_of(w, len(w))[0])].append(i)
        self.short_lengths = sorted({len(w) for w in self.words if 0 < len(w) < match})
        places = [(seeds_of(w, match), i) for i, w in enumerate(self.words) if len(w) >= match]
        keys = np.concatenate([p for p, _ in places] or [np.zeros(0, np.uint64)])
        owner = np.concatenate([np.full(len(p), i) for p, i in places] or [np.zeros(0, int)])
        at = np.concatenate([np.arange(len(p)) for p, _ in places] or [np.zeros(0, int)])
        order = np.argsort(keys, kind="stable")
        self.keys, self.owner, self.at = keys[order], owner[order], at[order]

    def known(self, seeds: np.ndarray) -> np.ndarray:
        """Places of the seeds that some item has."""
        if not len(self.keys):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.keys, seeds), len(self.keys) - 1)
        return np.flatnonzero(self.keys[at] == seeds)

    def hits(self, words: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """For each item that shares a seed: (place in the words, place in the item)."""
        found: dict[int, list[tuple[int, int]]] = defaultdict(list)
        seeds = seeds_of(words, self.match)
        for i in self.known(seeds):
            k = int(np.searchsorted(self.keys, seeds[i]))
            while k < len(self.keys) and self.keys[k] == seeds[i]:
                found[int(self.owner[k])].append((int(i), int(self.at[k])))
                k += 1
        for n in self.short_lengths:
            for i, seed in enumerate(seeds_of(words, n).tolist() if self.short else []):
                for owner in self.short.get(seed, ()):
                    found[owner].append((i, 0))
        return found


def tile(words: np.ndarray, item: np.ndarray, hits: list[tuple[int, int]], match: int) -> list[tuple[int, int, int]]:
    """Tiles ``(place in words, place in item, length)``, longest first."""
    match = min(match, len(item))
    runs: dict[int, list[int]] = defaultdict(list)
    for i, j in sorted(hits):
        if np.array_equal(words[i : i + match], item[j : j + match]):
            runs[i - j].append(i)
    by_length: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for shift, places in runs.items():
        begin = last = places[0]
        for i in [*places[1:], None]:
            if i is None or i > last + 1:
                by_length[last - begin + match].append((begin, begin - shift))
                begin = i
            last = i
    used_words, used_item, tiles = set(), np.zeros(len(item), bool), []
    while by_length:
        length = max(by_length)
        for i, j in by_length.pop(length):
            free = [not used_item[j + k] and i + k not in used_words for k in range(length)]
            if all(free):
                tiles.append((i, j, length))
                used_item[j : j + length] = True
                used_words.update(range(i, i + length))
                continue
            k = 0
            while k < length:  # what of the run is still free comes again at its length
                stop = k
                while stop < length and free[stop]:
                    stop += 1
                if stop - k >= match:
                    by_length[stop - k].append((i + k, j + k))
                k = stop + 1
    return tiles


def blocks_of(benchmark: DataFrame, match: int) -> Iterator[list[tuple[int, bytes]]]:
    """The items, some at a time, so many that they have ``BLOCK_SEEDS`` seeds at most.

    A single item beyond that is a block alone.
    """
    size = F.octet_length("text")
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null")
    window = Window.orderBy("item_id", "text").rowsBetween(Window.unboundedPreceding, 0)
    ordered = rows.withColumn("block", (F.sum(size).over(window) / (2 * BLOCK_SEEDS)).cast("long"))
    block: list[tuple[int, bytes]] = []
    number = None
    for r in ordered.toLocalIterator():
        if block and r["block"] != number:
            yield block
            block = []
        number = r["block"]
        block.append((r["item_id"], r["text"].encode()))
    yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, match: int = MATCH) -> DataFrame:
    """Every ``row`` of ``docs`` with ``leaks``: the items with tiles in its text.

    An array of ``item_id, coverage, tiles`` by ``item_id``; ``tiles`` are first word in the text, first word in the item and
    length. Rows of ``docs`` that repeat get equal results; null and empty texts, and
    an empty benchmark, get none. Items without a word never leak; items of fewer than
    ``match`` words leak where all their words stand together. Items that share an id
    are items of their own.
    """
    docs, found = docs.select(whole_row(docs)), None
    for n, rows in enumerate(blocks_of(benchmark, match)):
        if n and n % AT_ONCE == 0:
            docs, found = settle(docs.withColumn("leaks", found), "leaks"), F.col("leaks")
        leaks = leaks_in(text_of(), rows, match)
        found = leaks if found is None else F.concat(found, leaks)
    return docs.withColumn("leaks", F.array_sort(found))


def leaks_in(text: F.Column, rows: list[tuple[int, bytes]], match: int) -> F.Column:
    kind = "array<struct<item_id:bigint,coverage:double,tiles:array<array<int>>>>"
    made: list[Items] = []

    def leaks(texts: pa.Array) -> pa.Array:
        forget()
        if not made:
            made.append(Items(rows, match))
        items, out = made[0], []
        for _, raw, offsets in slabs(texts):
            words, doc = tokens(raw, offsets)
            bounds = np.searchsorted(doc, np.arange(len(offsets)))
            # one look at all seeds of the slab tells which texts to look at closer
            likely = set(range(len(offsets) - 1)) if items.short else set(doc[items.known(seeds_of(words, match))].tolist())
            for d in range(len(offsets) - 1):
                own = words[bounds[d] : bounds[d + 1]]
                hits = items.hits(own) if d in likely else {}
                out.append([leak(items, own, i, places) for i, places in sorted(hits.items())])
        return pa.array(out, ARROW)

    return F.arrow_udf(leaks, kind)(text)


ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("coverage", pa.float64()), ("tiles", pa.list_(pa.list_(pa.int32())))]))


def leak(items: Items, words: np.ndarray, i: int, places: list[tuple[int, int]]) -> dict:
    tiles = tile(words, items.words[i], places, items.match)
    covered = sum(length for _, _, length in tiles)
    return {"item_id": items.ids[i], "coverage": covered / len(items.words[i]), "tiles": tiles}


def contaminated(coverage: float = COVERAGE) -> F.Column:
    """Whether an item's share under tiles reaches ``coverage``."""
    return F.exists("leaks", lambda x: x["coverage"] >= coverage)
