"""Removal of byte strings that occur twice, by prefix doubling on sampled suffixes.

Prefix doubling ranks all suffixes by their first ``k`` bytes, then by pairs of ranks
``k`` apart, and drops a suffix once its rank is unique. Two things make it cheap here:

* Ranks are names: fingerprints that are equal where the prefixes are. Sorting names
  in their bucket brings equal prefixes together, which is all that is asked for, and
  a name of twice the length is made from the pair of names ``k`` bytes apart.
* The first round looks at sampled suffixes. Of each string of ``length`` bytes, that
  is the one inside whose first half-length prefix has the least name; equal strings
  sample equal ones. Neighbouring strings mostly share their sample and form a run.

Round one ranks the samples by half-length prefixes. A unique one drops its run. If all
runs of a sample are equal as a whole, they are settled as repeated. Round two ranks
every start in the other runs by its pair of half-length names, ``length`` bytes in all.

Strings may also consist of words: suffixes then begin at words, and a word's hash stands
in the place of a byte's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import BYTE_VALUES, NOT_SPACE, Rolling, finish, slabs, sliding_min, word_bounds
from .chunks import Chunks, column_of, covered, elsewhere, same_as_next, unpack
from .substring import LOW_VALUES

LENGTH = 400
ODD = np.uint64(0x9E3779B97F4A7C15)


class Bytes:
    """The bytes of some texts, as what strings consist of."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        self.raw, self.offsets, self.count = raw, offsets, len(raw)

    def values(self, of_bytes: np.ndarray) -> np.ndarray:
        """A number for each, made of the numbers given for each byte."""
        return of_bytes[self.raw]

    def mask(self, removed: np.ndarray) -> np.ndarray:
        """The bytes that go."""
        return removed


class Words:
    """The words of some texts: runs of bytes that are no ASCII white space."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        self.raw, self.ends = raw, offsets
        self.starts, self.stops = word_bounds(raw, offsets, NOT_SPACE)
        self.offsets, self.count = np.searchsorted(self.starts, offsets), len(self.starts)

    def values(self, of_bytes: np.ndarray) -> np.ndarray:
        return Rolling(of_bytes[self.raw]).runs(self.starts, self.stops)

    def mask(self, removed: np.ndarray) -> np.ndarray:
        """The bytes of words that go, with the white space behind them."""
        which = np.flatnonzero(removed)
        doc = np.searchsorted(self.offsets, which, "right") - 1
        stops = np.minimum(np.append(self.starts[1:], len(self.raw))[which], self.ends[doc + 1])
        change = np.zeros(len(self.raw) + 1, np.int64)
        change[self.starts[which]] += 1
        np.add.at(change, stops, -1)
        return np.cumsum(change)[:-1] > 0


class Runs:
    """The runs of starts in some texts that share their sample."""

    def __init__(self, places: Bytes | Words, length: int):
        self.places, self.length = places, length
        offsets, count = places.offsets, places.count
        self.half = (length + 1) // 2
        empty = np.zeros(0, np.int64)
        self.first = self.last = empty  # starts of a run's first and last string
        self.sample = self.whole = np.zeros(0, np.uint64)  # names of sample and run
        self.loose = np.zeros(0, bool)  # a run that may repeat inside itself
        if count < length:
            return
        self.rolling = Rolling(places.values(BYTE_VALUES))
        self.halves = self.rolling.windows(self.half)
        room = np.repeat(offsets[1:], np.diff(offsets))[: count - length + 1] - np.arange(count - length + 1)
        starts = np.flatnonzero(room >= length)
        if not len(starts):
            return
        bits = np.uint64((1 << max(20, int(count).bit_length())) - 1)
        place = np.arange(len(self.halves), dtype=np.uint64)
        width = length - self.half + 1
        rough = self.halves & ~bits
        left = (sliding_min(rough | place, width) & bits)[starts]
        right = (bits - (sliding_min(rough | (bits - place), width) & bits))[starts]
        sample = self.halves[left.astype(np.int64)]
        begins = np.ones(len(starts), bool)
        begins[1:] = (np.diff(starts) != 1) | (sample[1:] != sample[:-1])
        first = np.flatnonzero(begins)
        last = np.append(first[1:], len(starts)) - 1
        self.first, self.last = starts[first], starts[last]
        self.sample, self.loose = sample[first], left[first] != right[last]
        self.whole = self.rolling.runs(self.first, self.last + length)

    def starts(self, which: np.ndarray) -> np.ndarray:
        """All starts in the runs chosen."""
        first, count = self.first[which], (self.last - self.first + 1)[which]
        ends = np.cumsum(count)
        return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count - first, count)

    def names(self, starts: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, np.uint64)
        return finish(self.halves[starts] * ODD + self.halves[starts + self.length - self.half])

    def lows(self, starts: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, np.uint32)
        return (Rolling(self.places.values(LOW_VALUES)).runs(starts, starts + self.length) >> np.uint64(32)).astype(np.uint32)


class ChunkRuns:
    """All runs of a chunk, and the distinct samples and (sample, run) pairs."""

    def __init__(self, docs: pa.StructArray, kind: type[Bytes | Words], length: int):
        self.slabs = [Runs(kind(raw, offsets), length) for _, raw, offsets in slabs(column_of(docs, "text"))]
        self.counts = [len(r.first) for r in self.slabs]
        sample, whole, loose = (np.concatenate([getattr(r, n) for r in self.slabs] or [[]]) for n in ("sample", "whole", "loose"))
        whole, loose = whole.astype(np.uint64), loose.astype(bool)
        sample = finish(sample.astype(np.uint64))  # least names of many have low leading bits
        self.samples, self.sample_of = np.unique(sample, return_inverse=True)
        self.pairs, self.first_of, self.pair_of, times = np.unique(
            finish(sample * ODD + whole), return_index=True, return_inverse=True, return_counts=True
        )
        self.low = whole[self.first_of].astype(np.uint32)
        self.pair_twice = times > 1
        # of each sample: one of its runs, and whether there are others or loose ones
        order = np.lexsort((whole, sample))
        self.one = np.zeros(len(self.samples), np.uint64)
        self.one[self.sample_of] = whole
        self.several = np.zeros(len(self.samples), bool)
        self.several[self.sample_of[loose]] = True
        differ = (sample[order][1:] == sample[order][:-1]) & (whole[order][1:] != whole[order][:-1])
        self.several[self.sample_of[order[1:][differ]]] = True
        self.twice = np.bincount(self.sample_of, minlength=len(self.samples)) > 1
        self.loose = loose

    def split(self, of_runs: np.ndarray) -> list[np.ndarray]:
        """What holds for all runs, by slab."""
        return np.split(of_runs, np.cumsum(self.counts)[:-1]) if self.counts else []


def decide_samples(names, extras, chunk):
    """Whether a sample repeats, and whether its runs differ."""
    order = np.argsort(names, kind="stable")
    same = same_as_next(names[order])
    group = np.concatenate([[0], np.cumsum(~same)]) if len(names) else np.zeros(0, np.int64)
    groups = int(group[-1]) + 1 if len(group) else 0
    flags, one = extras["flags"][order], extras["one"][order]
    several = np.bincount(group, weights=flags & 2, minlength=groups) > 0
    differ = np.flatnonzero(same & (one[1:] != one[:-1]))
    several[group[differ]] = True
    repeats = (np.bincount(group, minlength=groups) > 1) | (np.bincount(group, weights=flags & 1, minlength=groups) > 0)
    found = np.zeros((2, len(names)), bool)
    found[:, order] = np.stack([repeats[group], several[group]]) if groups else 0
    return list(found)


def decide_pairs(names, extras, chunk):
    """Whether an equal run is in another chunk or twice in one, and the first chunk's."""
    order = np.lexsort((chunk, extras["low"], names))
    same = same_as_next(names[order], extras["low"][order])
    twice = np.zeros(len(names), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    later = np.zeros(len(names), bool)
    later[order[1:]] = same
    return [twice, ~later]


def find_repeats(
    chunks: Chunks, kind: type[Bytes | Words], length: int, mark: str = ""
) -> tuple[list[DataFrame], Callable[[dict, pa.StructArray], Iterator[np.ndarray]]]:
    """Answers on the strings of ``length`` places, and what makes masks of removed bytes of them.

    The columns of the answers begin with ``mark``. There is one mask for each slab of a chunk.
    """
    repeated, several, twice, first, again = (mark + n for n in ("repeats", "several", "twice", "first", "again"))

    def samples(known, rows):
        runs = ChunkRuns(rows, kind, length)
        flags = runs.twice.astype(np.uint8) | runs.several.astype(np.uint8) << 1
        return runs.samples, {"one": np.where(runs.several, 0, runs.one), "flags": flags}

    ranked = chunks.ask(samples, decide_samples, (repeated, several), {"one": "<u8", "flags": "u1"})

    def open_pairs(known, runs: ChunkRuns) -> np.ndarray:
        """Pairs whose sample has runs that differ."""
        found = unpack(known, repeated, several)
        return found[runs.sample_of[runs.first_of]] if len(found) else np.zeros(len(runs.pairs), bool)

    def whole_runs(known, rows):
        runs = ChunkRuns(rows, kind, length)
        some = open_pairs(known, runs)
        return runs.pairs[some], {"low": runs.low[some]}

    settled = chunks.ask(whole_runs, decide_pairs, (twice, first), {"low": "<u4"}, [ranked])

    def judged(known, runs: ChunkRuns) -> tuple[np.ndarray, np.ndarray]:
        """Runs that repeat as a whole, and those to be compared start by start."""
        some = open_pairs(known, runs)
        both, leads = runs.pair_twice & some, np.zeros(len(runs.pairs), bool)
        if some.any():
            both[some] |= unpack(known, twice, twice)
            leads[some] = unpack(known, twice, first)
        repeats = unpack(known, repeated, repeated)
        whole = np.zeros(len(runs.sample_of), bool)
        if len(repeats):
            whole = np.where(some[runs.pair_of], both[runs.pair_of], repeats[runs.sample_of])
        lead = np.zeros(len(runs.sample_of), bool)
        lead[runs.first_of] = leads
        return whole, some[runs.pair_of] & (lead | ~both[runs.pair_of])

    def compared(known, runs: ChunkRuns):
        """By slab: runs, starts to be compared, and their names."""
        for slab, which in zip(runs.slabs, runs.split(judged(known, runs)[1])):
            starts = slab.starts(np.flatnonzero(which))
            yield slab, starts, slab.names(starts)

    def doubled(known, rows):
        names, lows = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)]
        for slab, starts, found in compared(known, ChunkRuns(rows, kind, length)):
            names.append(found)
            lows.append(slab.lows(starts))
        distinct, at = np.unique(np.concatenate(names), return_index=True)
        return distinct, {"low": np.concatenate(lows)[at]}

    others = chunks.ask(doubled, elsewhere, (again,), {"low": "<u4"}, [ranked, settled])

    def masks(known, rows):
        runs = ChunkRuns(rows, kind, length)
        marks = runs.split(judged(known, runs)[0])
        found = list(compared(known, runs))
        names = [n for *_, n in found]
        keys, times = np.unique(np.concatenate(names), return_counts=True) if names else ([], None)
        if len(keys):
            more = (times > 1) | unpack(known, again, again)
        for whole, (slab, starts, own) in zip(marks, found):
            gone = [slab.starts(np.flatnonzero(whole))]
            if len(own):
                gone.append(starts[more[np.searchsorted(keys, own)]])
            yield slab.places.mask(covered(np.concatenate(gone), length, slab.places.count))

    return [ranked, settled, others], masks


def remove_repeats(docs: DataFrame, length: int = LENGTH, words: int | None = None) -> DataFrame:
    """Every ``row`` of ``docs`` with ``n_bytes, n_removed, n_spans, spans, kept, text``.

    A byte goes if a string of ``length`` bytes over it starts anywhere else, too, in
    another document or in its own; both occurrences go. With ``words``, so do strings of
    that many words, whatever their bytes and the white space in them, with the white space
    behind them. Strings are judged on the
    input and never cross documents. ``spans`` are the removed runs as ``start, stop``
    offsets, ``kept`` the bytes that stay, and ``text`` the same without characters
    that were cut in two. Null and empty texts have no bytes. Rows
    that repeat or share a ``doc_id`` are documents of their own.
    """
    chunks = Chunks(docs)
    answers, of_bytes = find_repeats(chunks, Bytes, length)
    kinds = [of_bytes]
    if words:
        more, of_words = find_repeats(chunks, Words, words, "word_")
        answers, kinds = answers + more, [of_bytes, of_words]

    def cut(known, rows):
        found = [list(masks(known, rows)) for masks in kinds]
        out = {"n_bytes": [], "n_removed": [], "n_spans": [], "spans": [], "kept": []}
        for (_, raw, offsets), *gone in zip(slabs(column_of(rows, "text")), *found):
            for column, values in zip(out.values(), kept_bytes(raw, offsets, np.logical_or.reduce(gone))):
                column += values
        texts = [kept.decode("utf-8", "ignore") for kept in out["kept"]]
        yield {"row": rows, "text": texts} | out

    added = "n_bytes long, n_removed long, n_spans long, spans array<array<long>>, kept binary, text string"
    return chunks.map(cut, chunks.with_rows(added), answers)


def kept_bytes(raw: np.ndarray, offsets: np.ndarray, removed: np.ndarray) -> tuple[list, ...]:
    """For each text: bytes, bytes removed, removed runs, those runs, the other bytes."""
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    mask = np.append(removed, False)
    before = np.concatenate([[False], mask[:-1]])
    starts, stops = np.flatnonzero(mask & (~before | edge)), np.flatnonzero(before & (~mask | edge))
    docs = len(offsets) - 1
    doc = np.searchsorted(offsets, starts, "right") - 1
    gone = np.bincount(doc, weights=stops - starts, minlength=docs).astype(np.int64)
    count = np.bincount(doc, minlength=docs)
    spans = np.column_stack([starts - offsets[doc], stops - offsets[doc]]).tolist()
    ends = np.cumsum(count).tolist()
    sizes = np.diff(offsets)
    left, stay = raw[~removed].tobytes(), np.cumsum(sizes - gone).tolist()
    texts = [left[a:b] for a, b in zip([0, *stay], stay)]
    lists = [spans[a:b] for a, b in zip([0, *ends], ends)]
    return sizes.tolist(), gone.tolist(), count.tolist(), lists, texts
