"""Texts as arrays of bytes: words, rolling hashes and sums for each document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import utf8

#: Bytes of text handled at once; a longer document is a slab of its own.
SLAB = 1 << 19

_rng = np.random.default_rng(20)
#: A random number for each byte, and an odd base with its inverse modulo 2**64.
BYTE_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C55
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)

#: What ``[^\x20\x09-\x0D]`` matches.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
#: Letters, digits and every byte of other alphabets.
WORD_BYTES = np.zeros(256, bool)
for _first, _last in ((48, 57), (65, 90), (97, 122), (128, 255)):
    WORD_BYTES[_first : _last + 1] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def slabs(column: pa.Array, size: int = SLAB) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of whole texts: first row, bytes, and the offset of each text."""
    raw, offsets = utf8(column)
    at = 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, raw[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at]
        at = stop


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        both = []
        for base in (BASE, pow(BASE, -1, 2**64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            both.append(np.cumprod(p))
        _powers = both[0], both[1]
    return _powers[0][:n], _powers[1][:n]


def finish(x: np.ndarray) -> np.ndarray:
    """Spread what differs over all bits; in place."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


class Rolling:
    """Hashes of any runs of ``values`` (unsigned 64-bit)."""

    def __init__(self, values: np.ndarray):
        power, self.inverse = powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * power[:-1], out=self.sums[1:])

    def windows(self, n: int) -> np.ndarray:
        """The hash of every ``n`` neighbouring values."""
        m = max(0, len(self.sums) - n)
        return finish((self.sums[n : n + m] - self.sums[:m]) * self.inverse[:m])

    def runs(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """The hash of each run; runs of other lengths differ, too."""
        x = (self.sums[stops] - self.sums[starts]) * self.inverse[starts]
        return finish(x ^ (stops - starts).astype(np.uint64) * np.uint64(0x94D049BB133111EB))


def word_bounds(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the runs of ``inside`` bytes; none crosses a document's end."""
    mask = np.zeros(len(raw) + 1, bool)
    mask[:-1] = inside[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(raw) + 1, bool)
    before[1:] = mask[:-1]
    starts = np.flatnonzero(mask & (~before | edge))
    stops = np.flatnonzero(before & (~mask | edge))
    return starts, stops


def word_hashes(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, document, start and stop of every word."""
    starts, stops = word_bounds(raw, offsets, inside)
    doc = np.searchsorted(offsets, starts, "right") - 1
    return Rolling(BYTE_VALUES[raw]).runs(starts, stops), doc, starts, stops


def doc_sums(values: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Sums of ``values`` for each document."""
    return np.bincount(doc, weights=values, minlength=docs)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbouring values."""
    done, least = 1, x
    while done < width:
        step = min(done, width - done)
        least = np.minimum(least[:-step], least[step:])
        done += step
    return least
