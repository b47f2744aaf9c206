"""Encode whole texts with a public tokenizer, each distinct piece once.

Both vocabularies split a text into pre-tokens that are encoded one by one, so a
text may be cut wherever a pre-token surely ends, and the ids of its pieces laid
end to end are the ids of the text:

* ``words``: white space is dropped between pre-tokens; cut at blanks and line ends.
* ``bytes``: a blank in front of a character that is no white space begins a
  pre-token; cut before it and nowhere else.

Pieces repeat far more often than texts. Arrow splits a batch of texts and numbers its
distinct pieces; a worker keeps the ids of pieces it has seen in one array and hands
only new ones to the library, many to a call, so nothing is done piece by piece but the look
for each distinct one. What parts the pieces of a call in the result: the first byte
of a piece is a blank for ``bytes``, and no other byte is; for ``words`` a control character
stands between them as a word. Once the memory holds ``LIMIT`` pieces, the half of them that
fewest batches used is forgotten.

A text that holds the string of a special token, such as ``<|endoftext|>``, goes to the
library whole, which takes such a string for one id; with ``special_as_text`` for text.
"""

from __future__ import annotations

import os
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import MEMORIES, release, utf8

#: Pieces a worker remembers; about 200 bytes each.
LIMIT = 300_000
#: Pieces in one library call.
TOGETHER = 512
#: New pieces after which freed memory goes back to the system.
TRIM = 5_000

INNER = re.compile(r" (?=\S)")
#: Stands between the pieces of one call.
MARK = "\x01"
#: How a byte-level vocabulary writes a blank.
BLANK = "\u0120"

_encoders: dict[tuple, PieceEncoder] = {}
MEMORIES.append(_encoders)


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str, cut: str, special_as_text: bool = False) -> PieceEncoder:
    """The worker's encoder for a tokenizer file, made at its first use."""
    key = path, cut, special_as_text
    if key not in _encoders:
        _encoders[key] = PieceEncoder(*key)
    return _encoders[key]


class Grown:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.array, self.size = np.zeros(1024, kind), 0

    def extend(self, values: np.ndarray) -> None:
        stop = self.size + len(values)
        if stop > len(self.array):
            self.array = np.resize(self.array, max(stop, 2 * len(self.array)))
        self.array[self.size : stop] = values
        self.size = stop


class Memory:
    """Pieces by name, where the ids of each lie in one array, and how many batches used it."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.starts, self.lengths, self.ids = Grown(np.int64), Grown(np.int64), Grown(np.uint32)
        self.used = Grown(np.int32)

    def add(self, pieces: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        """New pieces, whose ``ids`` lie end to end."""
        self.starts.extend(self.ids.size + np.cumsum(lengths) - lengths)
        self.lengths.extend(lengths)
        self.ids.extend(ids)
        self.used.extend(np.zeros(len(pieces), np.int32))
        self.number.update(zip(pieces, range(len(self.number), len(self.number) + len(pieces))))

    def find(self, pieces: list[str]) -> np.ndarray:
        """The number of each piece, -1 for those that aren't there."""
        return np.fromiter(map(self.number.get, pieces, repeat(-1)), np.int64, len(pieces))

    def joined(self, numbers: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The ids of the pieces, end to end; of some with ``lengths`` zero nothing."""
        before = np.cumsum(lengths) - lengths
        at = np.repeat(self.starts.array[numbers] - before, lengths)
        at += np.arange(len(at))
        return self.ids.array[at]

    def most_used(self, n: int) -> Memory:
        """A memory of the ``n`` pieces that most batches used, the later ones of equals."""
        order = np.argsort(self.used.array[: self.used.size], kind="stable")
        kept = np.sort(order[max(0, len(order) - n) :])
        names, lengths, memory = list(self.number), self.lengths.array[kept], Memory()
        memory.add([names[i] for i in kept.tolist()], self.joined(kept, lengths), lengths)
        memory.used.array[: len(kept)] = self.used.array[kept] // 2  # what was frequent long ago goes, too
        return memory


class PieceEncoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, cut: str, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if cut not in ("words", "bytes"):
            raise ValueError(f"cut must be words or bytes, not {cut!r}")
        self.cut = cut
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = special_as_text
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = None if special_as_text or not special else "|".join(map(re.escape, special))
        names = self.library.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(names.values()) + 1, bool)  # by id: a piece begins, or the mark
        if cut == "bytes":
            self.opens[[i for name, i in names.items() if name.startswith(BLANK)]] = True
        else:
            self.opens[self.ids([MARK])[0]] = True
        self.known = Memory()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; what the library gives for the whole text."""
        ids, lengths = self.encode_all(pa.array(texts, pa.string()))
        return [x.tobytes() for x in np.split(ids, np.cumsum(lengths)[:-1])] if texts else []

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has; null texts have none."""
        if len(self.known.number) > LIMIT:
            self.known = self.known.most_used(LIMIT // 2)
        texts = texts.fill_null("")
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " ") if self.cut == "words" else texts, " ")
        counts = lists.value_lengths().to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(texts)), counts)
        firsts = np.cumsum(counts) - counts
        coded = lists.flatten().dictionary_encode()
        piece = coded.indices.to_numpy().astype(np.int64)
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # faster than to_pylist
        odd = np.zeros(len(texts), bool)
        if self.special:
            odd |= pc.match_substring_regex(texts, self.special, ignore_case=True).to_numpy(zero_copy_only=False)
        if self.cut == "bytes":
            # no blank stands before the first piece of a text; such pieces are marked by one
            heads = [" " + distinct[p] for p in piece[firsts]]
            number = {h: i for i, h in enumerate(dict.fromkeys(heads), len(distinct))}
            piece[firsts] = [number[h] for h in heads]
            unsafe = opens_odd(coded.dictionary, distinct)
            distinct += number
            if unsafe:
                wrong = np.zeros(len(distinct), bool)
                wrong[unsafe] = True
                odd[row[wrong[piece]]] = True
                for i in unsafe:
                    distinct[i] = " "  # encoded as nothing; the texts are done below
        numbers = self.numbers(distinct)[piece]
        lengths = self.known.lengths.array[numbers]
        lengths[odd[row]] = 0
        ids = self.known.joined(numbers, lengths)
        sizes = np.bincount(row, weights=lengths, minlength=len(texts)).astype(np.int64)
        if not odd.any():
            return ids, sizes
        parts = np.split(ids, np.cumsum(sizes)[:-1])
        for i in np.flatnonzero(odd).tolist():
            parts[i] = self.encode_alone(texts[i].as_py())
            sizes[i] = len(parts[i])
        return np.concatenate(parts), sizes

    def encode_alone(self, text: str) -> np.ndarray:
        """Ids of a text with special tokens, or with white space of other kinds before words."""
        if self.cut == "words" or self.special and re.search(self.special, text, re.IGNORECASE):
            return self.ids([text])[0]
        first, *pieces = INNER.split(text)
        pieces = [" " + first, *pieces]
        numbers = self.numbers(pieces)
        return self.known.joined(numbers, self.known.lengths.array[numbers])

    def spelled(self, piece: str) -> str:
        """The text that a piece stands for."""
        if self.cut == "words":
            return piece
        return piece[1:] if piece.startswith(" ") else " " + piece

    def numbers(self, pieces: list[str]) -> np.ndarray:
        """The number of each piece; new ones are learnt."""
        found = self.known.find(pieces)
        new = np.flatnonzero(found < 0).tolist()
        if new:
            self.learn(list(dict.fromkeys(pieces[i] for i in new)))
            found[new] = self.known.find([pieces[i] for i in new])
        self.known.used.array[found] += 1
        return found

    def learn(self, pieces: list[str]) -> None:
        many, alone = [], []
        for p in pieces:
            (alone if len(p) > 1_000 or " " in p or MARK in p or not p else many).append(p)
        groups = [many[i : i + TOGETHER] for i in range(0, len(many), TOGETHER)]
        before, between = (" ", " ") if self.cut == "bytes" else (f"{MARK} ", f" {MARK} ")
        for group in groups:  # what the library returns is far larger than the ids: one at a time
            ids = self.ids([before + between.join(group)])[0]
            opens = self.opens[ids]
            begins = np.flatnonzero(opens)
            if len(begins) != len(group):
                alone += group
                continue
            lengths = np.diff(begins, append=len(ids))
            if self.cut == "words":
                ids, lengths = ids[~opens], lengths - 1
            self.known.add(group, ids, lengths)
        if alone:
            ids = self.ids([self.spelled(p) for p in alone])
            self.known.add(alone, np.concatenate(ids), np.array([len(x) for x in ids]))
        if len(many) > TRIM:
            release()

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, "<u4") for f in found]


def opens_odd(pieces: pa.Array, names: list[str]) -> list[int]:
    """Which pieces are empty or begin with white space other than a blank; ``names`` are the same."""
    raw, offsets = utf8(pieces)
    odd = np.diff(offsets) == 0
    first = raw[offsets[:-1][~odd]]
    odd[~odd] = (first < 0x20) | (first >= 0x80)  # the few that are looked at one by one
    return [i for i in np.flatnonzero(odd).tolist() if not names[i] or names[i][0].isspace()]


def closed(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """``ids`` with an end id behind each text."""
    lengths = lengths + 1
    out = np.empty(len(ids) + len(lengths), np.uint32)
    ends = np.zeros(len(out), bool)
    ends[np.cumsum(lengths) - 1] = True
    out[ends], out[~ends] = end_id, ids
    return out, lengths
