"""Removal of word windows that appeared before, by level-wise doubling.

A window of ``window`` words can only repeat if the windows of half its length that it
holds repeat. The first level looks at the half-length windows, of each full window
only at the one with the least fingerprint: equal windows choose equal ones, so none is
lost, and few are looked at. Where that one appears nowhere else, the full window is
dropped. What repeated is extended to twice the length and compared again; a full
window repeats if its name does, and the later ones are removed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import BYTE_VALUES, NOT_SPACE, Rolling, finish, slabs, sliding_min, word_bounds
from .chunks import Chunks, column_of, elsewhere, same_as_next, unpack

WINDOW = 20
#: A second random number for each byte, for the low bits of names.
LOW_VALUES = np.random.default_rng(21).integers(1, 2**63, 256, dtype=np.uint64)
LEAST_ID = -(2**63)


class Words:
    """The words of some texts and the names of their windows."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, window: int):
        self.raw, self.offsets, self.window = raw, offsets, window
        self.starts, self.stops = word_bounds(raw, offsets, NOT_SPACE)
        self.doc = np.searchsorted(offsets, self.starts, "right") - 1
        self.words = Rolling(Rolling(BYTE_VALUES[raw]).runs(self.starts, self.stops))
        n = len(self.starts)
        at = np.arange(max(0, n - window + 1))
        self.at = at[self.doc[at] == self.doc[at + window - 1]] if len(at) else at

    def seeds(self) -> np.ndarray:
        """For each window the least name of those of half its length inside."""
        if not len(self.at):
            return np.zeros(0, np.uint64)
        half = (self.window + 1) // 2
        least = sliding_min(self.words.windows(half), self.window - half + 1)[self.at]
        return finish(least)  # least names of many have low leading bits

    def names(self, which: np.ndarray) -> np.ndarray:
        """Names of windows: of the pair of their halves."""
        if not len(which):
            return np.zeros(0, np.uint64)
        half = (self.window + 1) // 2
        halves, at = self.words.windows(half), self.at[which]
        return finish(halves[at] * np.uint64(0x9E3779B97F4A7C15) + halves[at + self.window - half])

    def lows(self, which: np.ndarray) -> np.ndarray:
        if not len(which):
            return np.zeros(0, np.uint32)
        second = Rolling(Rolling(LOW_VALUES[self.raw]).runs(self.starts, self.stops))
        at = self.at[which]
        return (second.runs(at, at + self.window) >> np.uint64(32)).astype(np.uint32)


def parts(docs: pa.StructArray, window: int):
    """First row and words of each slab of a chunk."""
    for row, raw, offsets in slabs(column_of(docs, "text")):
        yield row, Words(raw, offsets, window)


def seeds_of(docs: pa.StructArray, window: int) -> np.ndarray:
    found = [np.unique(words.seeds()) for _, words in parts(docs, window)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def in_order(keys: np.ndarray, marked: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The marks of ``values`` among the ordered ``keys``, which hold them all."""
    return marked[np.searchsorted(keys, values)] if len(values) else np.zeros(0, bool)


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every ``row`` of ``docs`` with ``n_words, n_removed, kept``.

    Words are runs of characters that are no ASCII white space. A word goes if a
    window over it starts earlier, too: in a document of smaller ``doc_id`` or further
    ahead in its own. Windows are judged on the input. ``kept`` is what stays, parted
    by single blanks. Null and empty texts have no words. Rows that share a ``doc_id``
    come one after the other as they are stored, so of equal rows one keeps its words;
    null ids come first.
    """
    chunks = Chunks(docs)

    def first_level(known, rows):
        return seeds_of(rows, window), {}

    repeated = chunks.ask(first_level, elsewhere, ("seed",), {})

    def local(rows):
        """Names of all windows of the chunk, and those that begin earlier in it."""
        names = [words.names(np.arange(len(words.at))) for _, words in parts(rows, window)]
        every = np.concatenate(names) if names else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        later = np.zeros(len(every), bool)
        later[order[1:]] = same_as_next(every[order])
        return every, later

    def extended(known, rows):
        """Slab by slab, the windows whose seed other chunks have, and their names."""
        keys, marked = seeds_of(rows, window), unpack(known, "seed", "seed")
        for row, words in parts(rows, window) if marked.any() else ():
            which = np.flatnonzero(in_order(keys, marked, words.seeds()))
            yield row, words, which, words.names(which)

    def second_level(known, rows):
        names, lows, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for row, words, which, found in extended(known, rows):
            names.append(found)
            lows.append(words.lows(which))
            at.append(words.doc[words.at[which]] + row)
        names, first = np.unique(np.concatenate(names), return_index=True)
        ids = column_of(rows, "doc_id").cast(pa.int64()).fill_null(LEAST_ID).to_numpy()
        return names, {"low": np.concatenate(lows)[first], "doc": ids[np.concatenate(at)[first]]}

    def earlier(names, extras, chunk):
        order = np.lexsort((chunk, extras["doc"], extras["low"], names))
        found = np.zeros(len(names), bool)
        found[order[1:]] = same_as_next(names[order], extras["low"][order])
        return [found]

    before = chunks.ask(second_level, earlier, ("name",), {"low": "<u4", "doc": "<i8"}, [repeated])

    def finish_chunk(known, rows):
        keys = [names for *_, names in extended(known, rows)]
        keys, marked = np.unique(np.concatenate(keys)) if keys else [], unpack(known, "name", "name")
        every, later = local(rows)
        at, out = 0, {"n_words": [], "n_removed": [], "kept": []}
        for _, words in parts(rows, window):
            n = len(words.at)
            gone = later[at : at + n].copy()
            if len(keys):
                names = every[at : at + n]
                place = np.minimum(np.searchsorted(keys, names), len(keys) - 1)
                gone |= marked[place] & (keys[place] == names)
            at += n
            change = np.zeros(len(words.starts) + 1, np.int64)
            change[words.at[gone]] += 1
            np.add.at(change, words.at[gone] + window, -1)
            removed = np.cumsum(change)[:-1] > 0
            for column, values in zip(out.values(), kept_words(words, removed)):
                column += values
        yield {"row": rows} | out

    return chunks.map(finish_chunk, chunks.with_rows("n_words long, n_removed long, kept string"), [repeated, before])


def kept_words(words: Words, removed: np.ndarray) -> tuple[list, list, list]:
    """For each text: words, words removed, and the others joined by blanks."""
    docs = len(words.offsets) - 1
    total = np.bincount(words.doc, minlength=docs)
    gone = np.bincount(words.doc[removed], minlength=docs)
    stay = np.flatnonzero(~removed)
    starts, stops, doc = words.starts[stay], words.stops[stay], words.doc[stay]
    # a word and the white space behind it, if another word of the text stays
    more = np.zeros(len(stay), bool)
    more[:-1] = doc[1:] == doc[:-1]
    change = np.zeros(len(words.raw) + 1, np.int8)
    change[starts] += 1
    change[stops] -= 1
    inside = np.cumsum(change[:-1], dtype=np.int8) > 0
    raw = words.raw.copy()
    raw[stops[more]] = 32
    inside[stops[more]] = True
    sizes = np.bincount(doc, weights=stops - starts + more, minlength=docs).astype(np.int64)
    joined, ends = raw[inside].tobytes(), np.cumsum(sizes)
    texts = [joined[e - k : e].decode("utf-8", "replace") for e, k in zip(ends.tolist(), sizes.tolist())]
    return total.tolist(), gone.tolist(), texts

