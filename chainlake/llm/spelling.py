"""Spelling variants: words one edit apart, found by composing finite-state machines.

The vocabulary is a minimised acceptor ``A``. Composed with a transducer ``E`` that allows
one inserted, deleted or replaced character and with ``A`` again, it accepts exactly the
pairs of near words. Until the edit both tapes read the same characters, so ``A . E . A``
stays on states ``(q, q)``, and a pair's edit is taken where its words first differ.

That splits the work by initial states. Take a pair whose shorter word has ``m`` characters
and that first differs at place ``x``. For a window ``low <= x < high`` both words have the
same first ``low`` and the same last ``m - high`` characters: they leave from one state of
the acceptor, reached by that beginning, and end in one state of the reversed acceptor. Each
word goes to the two windows that halve its places, once as the shorter word of a pair and
once as the longer one. Groups that are still too large halve their window again, so even if
all words begin alike no group stays large: words that agree in all but one place are no
more than there are letters. In a group the machines are built over what lies between the
shared ends, and the accepted pairs are enumerated.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, settle, together

LETTERS = "[a-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words are at least this long and this frequent; the more frequent word of a form is this
#: many times as frequent.
LEAST_LENGTH, LEAST_COUNT, TIMES = 5, 3, 2
#: One of so many runs loses a character.
ONE_OF = 97
#: Characters of a group that is not split further.
GROUP = 500_000

KEYS = ("h", "m", "low", "high")


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, one_of: int = ONE_OF) -> DataFrame:
    """``word, n`` of all frequent words of ``docs.text``; a null text has none.

    Runs of letters, with A-Z lower-cased. Where ``one_of`` divides the CRC-32 of
    ``<doc_id>:<run>``, the run loses the character at that number modulo its length; a null
    ``doc_id`` counts as empty there.
    """
    lowered = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    runs = docs.select(doc_id.alias("doc"), F.explode(F.regexp_extract_all(lowered, F.lit(LETTERS), F.lit(0))).alias("run"))
    hashed = runs.withColumn("crc", F.crc32(F.concat("doc", F.lit(":"), "run")))
    at = (F.col("crc") % F.length("run")).cast("int")
    shorter = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("crc") % one_of == 0, shorter).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least_count)


def halves(low: F.Column, high: F.Column) -> F.Column:
    """The two halves of a window."""
    middle = F.floor((low + high) / 2).cast("int")
    return F.array(F.struct(low.alias("low"), middle.alias("high")), F.struct(middle.alias("low"), high.alias("high")))


def keyed(rows: DataFrame) -> DataFrame:
    """Rows with ``h``, the hash of what the words of a group share."""
    last = F.greatest(F.col("m") - F.col("high"), F.lit(0))
    ends = (F.substr("word", F.lit(1), F.col("low")), F.when(last > 0, F.substr("word", -last)).otherwise(""))
    return rows.select(F.xxhash64(*ends).alias("h"), "m", "low", "high", "word", "n")


def first_windows(words: DataFrame) -> DataFrame:
    """Each word in the halves of its places, as the shorter and the longer word."""
    m = F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("m")
    window = F.explode(halves(F.lit(0), F.col("m") + 1)).alias("w")
    return keyed(words.select("word", "n", m).where("m > 0").select("*", window).select("word", "n", "m", "w.low", "w.high"))


def narrowed(rows: DataFrame) -> DataFrame:
    """Rows with their window halved."""
    window = F.explode(halves(F.col("low"), F.col("high"))).alias("w")
    return keyed(rows.select("word", "n", "m", window).select("word", "n", "m", "w.low", "w.high"))


def near_words(words: DataFrame, group: int = GROUP) -> DataFrame:
    """``a, a_n, b, b_n``: every pair of near words of stored ``word, n``, once.

    ``group``: characters of a group above which its window is halved.
    """
    rows, cool = first_windows(words), []
    while True:
        sizes = rows.groupBy(*KEYS).agg(F.sum(F.length("word")).alias("size"))
        hot = settle(sizes.where((F.col("size") > group) & (F.col("high") - F.col("low") > 1)).select(*KEYS), "hot")
        if hot.isEmpty():
            cool.append(rows)
            break
        cool.append(rows.join(hot, list(KEYS), "left_anti"))
        rows = narrowed(rows.join(hot, list(KEYS), "left_semi"))
    dealt = cool[0]
    for more in cool[1:]:
        dealt = dealt.unionByName(more)
    dealt = dealt.repartition("h").sortWithinPartitions(*KEYS, "word")
    return arrow_rows(dealt, enumerate_groups, "a string, a_n long, b string, b_n long")


def enumerate_groups(batches: Iterator[dict]) -> Iterator[dict]:
    """Pairs of each group of rows that are in order."""

    def pairs() -> Iterator[tuple]:
        group, key = [], None
        for batch in batches:
            keys = zip(*(batch[c].to_pylist() for c in KEYS))
            for k, word, n in zip(keys, batch["word"].to_pylist(), batch["n"].to_pylist()):
                if k != key:
                    if len(group) > 1:
                        yield from pairs_of_group(*key[1:], group)
                    group, key = [], k
                group.append((word, n))
        if len(group) > 1:
            yield from pairs_of_group(*key[1:], group)

    names = ("a", "a_n", "b", "b_n")
    return together((dict(zip(names, pair)) for pair in pairs()), lambda row: len(row["a"]))


def pairs_of_group(m: int, low: int, high: int, group: list[tuple[str, int]]) -> Iterator[tuple[str, int, str, int]]:
    """Near pairs among words of one window; the shorter first, else the smaller."""
    last = max(m - high, 0)
    inner: dict[tuple[str, str], tuple[dict, dict]] = {}
    for word, n in group:  # words that only share the hash part here
        stop = len(word) - last
        same, longer = inner.setdefault((word[:low], word[stop:]), ({}, {}))
        (same if len(word) == m else longer)[word[low:stop]] = n
    for (head, tail), (same, longer) in inner.items():
        if len(same) + len(longer) > 1 and same:
            for a, b in accepted_pairs(sorted(same), sorted(longer), high - low):
                yield head + a + tail, same[a], head + b + tail, same[b] if len(b) == len(a) else longer[b]


class Acceptors:
    """Minimised acceptors that share their states; a state's number names what it accepts."""

    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.final: list[bool] = []
        self.arcs: list[dict[str, int]] = []

    def state(self, final: bool, arcs: list[tuple[str, int]]) -> int:
        key = final, tuple(arcs)
        if key not in self.known:
            self.known[key] = len(self.final)
            self.final.append(final)
            self.arcs.append(dict(arcs))
        return self.known[key]

    def build(self, words: list[str]) -> int:
        """The initial state of the acceptor of ``words``, distinct and in order."""
        path, before = [(False, [])], ""
        for word in [*words, ""]:
            same = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                same += 1
            while len(path) - 1 > same:
                done = self.state(*path.pop())
                path[-1][1].append((before[len(path) - 1], done))
            path.extend((False, []) for _ in range(len(word) - same))
            if word or (words and words[0] == ""):
                path[-1] = True, path[-1][1]
            before = word
        return self.state(*path[0])


def spelled(chain: tuple | None) -> str:
    """The characters of a chain ``(before, character)``."""
    out = []
    while chain is not None:
        chain, c = chain
        out.append(c)
    return "".join(reversed(out))


def accepted_pairs(same: list[str], longer: list[str], window: int) -> Iterator[tuple[str, str]]:
    """Pairs that ``A . E . A`` accepts with the edit at one of the first ``window`` places.

    ``same`` are words of one length, ``longer`` those with one more character. A word is
    replaced by one of its own length or becomes a longer one.
    """
    machine = Acceptors()
    start = machine.build(same), machine.build(longer) if longer else None
    arcs = machine.arcs
    todo = [(*start, 0, None)]
    while todo:
        p, q, place, read = todo.pop()
        if place < window:
            out = list(arcs[p].items())
            for i, (x, after_x) in enumerate(out):
                for y, after_y in out[i + 1 :]:
                    for rest in both_accept(machine, after_x, after_y, None):
                        yield f"{(head := spelled(read))}{x}{rest}", f"{head}{y}{rest}"
            if q is not None:
                for x, after in arcs[q].items():
                    for rest in both_accept(machine, p, after, x):
                        yield f"{(head := spelled(read))}{rest}", f"{head}{x}{rest}"
            for x, after in out:
                follow = None if q is None else arcs[q].get(x)
                if arcs[after] or follow is not None:
                    todo.append((after, follow, place + 1, (read, x)))


def both_accept(machine: Acceptors, p: int, q: int, banned: str | None) -> Iterator[str]:
    """What both states accept; ``banned`` doesn't begin it."""
    arcs, final = machine.arcs, machine.final
    todo = [(p, q, None)]
    while todo:
        p, q, read = todo.pop()
        if final[p] and final[q]:
            yield spelled(read)
        one, other = arcs[p], arcs[q]
        for x in one if len(one) <= len(other) else other:
            if x in one and x in other and (read is not None or x != banned):
                todo.append((one[x], other[x], (read, x)))


def follow_forms(forms: DataFrame) -> DataFrame:
    """``word, root``: the last of the forms that follow from each ``word, form``.

    A form is more frequent than its word, so there are no rings. Each round doubles the
    steps taken.
    """
    ends = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = ends.join(further, "root", "left")
        ends = settle(moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if ends.where("moved").isEmpty():
            return ends.select("word", "root")
        ends = ends.select("word", "root")


def group_variants(docs: DataFrame, times: int = TIMES, group: int = GROUP, **limits: int) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every frequent word of ``docs``.

    Near words differ by exactly one edit. ``form`` is the near word of largest ``n``, the
    first in code-point order of equals, if that is ``times`` the word's own or more; else
    null. ``root`` is where forms lead to. ``limits`` are those of :func:`vocabulary`. Repeated
    rows count again, null and empty texts and an empty table give no words, other columns
    are not read.
    """
    words = settle(vocabulary(docs, **limits), "words")
    pairs = settle(near_words(words, group), "pairs")
    turned = pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("a_n").alias("b_n"))
    best = F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form"))).alias("best")
    near = pairs.select("a", "b", "b_n").unionByName(turned).groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), best)
    met = words.join(near, "word", "left")
    more = -F.col("best.less") >= times * F.col("n")
    formed = settle(
        met.select(
            "word",
            F.when(more, F.col("best.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(more, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = follow_forms(formed.where("form is not null"))
    whole = formed.join(roots, "word", "left")
    return whole.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
