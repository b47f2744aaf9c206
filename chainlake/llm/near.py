"""Near copies by exact Jaccard similarity of word shingles, most of them found by SimHash.

Every text is the set of the hashes of its shingles; texts of equal sets are one. Anchor-point
covering (:mod:`simhash`) of the sets' fingerprints proposes the first pairs, which make the
bulk of a group of copies one component. An exact search then finds what is left: two sets
of similarity ``t`` or more share one of the first ``n - ceil(t * n) + 1`` hashes of either, in
whatever order all sets are put. The order is by how many sets have a hash, the rarest first,
so a hash that only one set has, as nearly all are, brings nothing together and isn't sent,
and what many texts share is a beginning only where a text has next to nothing else.

Pairs that meet and can still be similar by their sizes, places and bitmaps are compared on
the sets. A bitmap has the parity of the hashes that fall on each of its bits, so two of them
differ in no more bits than the sets do in hashes. First each set is compared with one of
those it meets, then those whose components differ meet in full. In a group of edited copies the
first is the one with the most hashes that others have, too, which is what they were made from. Texts are stored in chunks and never shuffled; sets are sent once to each
partner, and one that is the partner of many is sent once for a thousand of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import LOWER, NOT_SPACE, Rolling, slabs, word_hashes
from .chunks import Chunks, column_of, same_as_next, unpack
from .common import arrow_rows, settle, utf8
from .components import components
from .simhash import BITS, MAX_BITS, link_fingerprints

SHINGLE, SIMILAR = 5, 0.8
#: Partners of one set that meet it in one group.
TOGETHER = 1_000
#: Sets of one hash that meet in one task, and pairs looked at together.
CROWD, PAIRS = 1 << 15, 1 << 18
#: 64-bit words of a set's bitmap.
BITMAP = 8
#: Bits of the class of a hash: the logarithm of how many sets have it.
CLASS_BITS = 6


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, ascending.

    Words and small letters are those of :func:`simhash.fingerprint`. A text of fewer
    words than a shingle is one shingle, a text without a word has none.
    """
    for _, raw, offsets in slabs(texts):
        words, doc, _, _ = word_hashes(LOWER[raw], offsets, NOT_SPACE)
        bounds = np.searchsorted(doc, np.arange(len(offsets)))
        for a, b in zip(bounds, bounds[1:]):
            yield np.unique(Rolling(words[a:b]).windows(min(shingle, b - a))) if b > a else np.zeros(0, np.uint64)


def share(n: int, similar: float) -> int:
    """The least number of ``n`` hashes that a similar set has, too."""
    return math.ceil(similar * n - 1e-9)


def name_of(found: np.ndarray) -> int:
    """A hash of a whole set."""
    return int(Rolling(found).windows(len(found)).view(np.int64)[0]) if len(found) else 0


def print_of(found: np.ndarray) -> int:
    """The fingerprint of a set: each bit as in most of its hashes."""
    raw = found.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(raw[:, i], minlength=256) @ BITS for i in range(7, -1, -1)])
    return int(np.packbits(ones * 2 > len(found)).view(">i8")[0])


def wanted_sets(known: dict, rows: pa.StructArray, shingle: int) -> Iterator[tuple[dict, np.ndarray]]:
    """The wanted rows of a chunk with their sets."""
    wanted = known["wanted"] or []
    texts = text_column(rows).take(pa.array([w["at"] for w in wanted], pa.int32()))
    return zip(wanted, shingle_sets(texts, shingle))


def bitmap_of(found: np.ndarray) -> bytes:
    """The parity of the hashes on each bit."""
    bit = (found * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.int64) % (64 * BITMAP)
    return np.packbits(np.bincount(bit, minlength=64 * BITMAP) & 1).tobytes()


class Sets:
    """The distinct shingle sets of ``docs``, which stay in chunks.

    ``rows``: ``chunk, at, doc_id, sig`` of every row; ``sets``: ``sig, n, fp`` and the row that
    stands for it, as ``chunk, at``.
    """

    def __init__(self, docs: DataFrame, shingle: int = SHINGLE, similar: float = SIMILAR):
        self.chunks, self.shingle, self.similar = Chunks(docs), shingle, similar

        def describe(known, rows):
            found = list(shingle_sets(text_column(rows), shingle))
            ids = column_of(rows, "doc_id").cast(pa.int64())
            yield {
                "chunk": np.full(len(rows), known["chunk"]), "at": np.arange(len(rows)), "doc_id": ids,
                "sig": [name_of(f) for f in found], "n": [len(f) for f in found], "fp": [print_of(f) for f in found],
            }

        described = self.chunks.map(describe, "chunk long, at int, doc_id long, sig long, n int, fp long")
        self.rows = settle(described, "rows")
        first = F.min(F.struct("chunk", "at", "n", "fp")).alias("first")
        self.sets = settle(self.rows.groupBy("sig").agg(first).select("sig", "first.*"), "sets")

    def places(self, wanted: DataFrame) -> DataFrame:
        """Rows of ``chunk, at, …`` as an answer to their chunks."""
        names = [c for c in wanted.columns if c != "chunk"]
        return wanted.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct(*names))).alias("wanted"))

    def beginnings(self) -> DataFrame:
        """``hash, sig, n, at, own, bits``: first hashes of every set that other sets have, too.

        ``own`` counts the hashes that the set alone has, ``bits`` is its bitmap.
        """
        places = settle(self.places(self.sets.select("chunk", "at", "sig")), "places")
        shingle, similar = self.shingle, self.similar

        def names(known, rows):
            every = [np.zeros(0, np.uint64), *(found for _, found in wanted_sets(known, rows, shingle))]
            distinct, times = np.unique(np.concatenate(every), return_counts=True)
            return distinct, {"weight": np.frexp(times)[1]}

        marks = tuple(f"class{i}" for i in range(CLASS_BITS))
        ranked = self.chunks.ask(names, decide_classes, marks, {"weight": "u1"}, [places], short=True)

        def begin(known, rows):
            found = list(wanted_sets(known, rows, shingle))
            distinct = np.unique(np.concatenate([np.zeros(0, np.uint64), *(f for _, f in found)]))
            classes = sum(unpack(known, marks[0], m).astype(np.int64) << i for i, m in enumerate(marks))
            for wanted, own in found:
                n = len(own)
                rank = classes[np.searchsorted(distinct, own)] if n else np.zeros(0, np.int64)
                first = np.lexsort((own, rank))[: n - share(n, similar) + 1]
                at = np.flatnonzero(rank[first] > 1)
                if len(at):
                    facts = {"sig": wanted["sig"], "n": n, "own": int((rank == 1).sum()), "bits": bitmap_of(own)}
                    yield {"hash": own[first[at]].view(np.int64), "at": at} | {c: [v] * len(at) for c, v in facts.items()}

        schema = "hash long, sig long, n int, at int, own int, bits binary"
        return settle(self.chunks.map(begin, schema, [places, ranked]), "beginnings")

    def similar_pairs(self, pairs: DataFrame) -> DataFrame:
        """Those of ``a, b`` (sets by name) whose Jaccard similarity is large enough.

        The side with more partners is sent to groups of them, the other to its partners.
        """
        pairs, shingle, similar = settle(pairs, "pairs"), self.shingle, self.similar
        often = pairs.select(F.explode(F.array("a", "b")).alias("sig")).groupBy("sig").count()
        counted = pairs.join(often.toDF("a", "a_count"), "a").join(often.toDF("b", "b_count"), "b")
        swap = F.col("b_count") > F.col("a_count")
        hub, member = F.when(swap, F.col("b")).otherwise(F.col("a")), F.when(swap, F.col("a")).otherwise(F.col("b"))
        groups = F.ceil(F.greatest("a_count", "b_count") / TOGETHER)
        dealt = counted.select(hub.alias("hub"), member.alias("member"), groups.alias("groups"))
        dealt = settle(dealt.withColumn("part", F.pmod(F.xxhash64("member"), "groups")), "dealt")
        to_hubs = dealt.select(F.col("hub").alias("sig"), "hub", "part", F.lit(False).alias("member")).distinct()
        to_members = dealt.select(F.col("member").alias("sig"), "hub", "part", F.lit(True).alias("member"))
        goals = to_hubs.unionByName(to_members).groupBy("sig").agg(F.collect_list(F.struct("hub", "part", "member")).alias("goals"))
        places = settle(self.places(self.sets.join(goals, "sig").select("chunk", "at", "sig", "goals")), "places")

        def send(known, rows):
            for wanted, own in wanted_sets(known, rows, shingle):
                goals, raw = wanted["goals"], own.tobytes()
                for at in range(0, len(goals), max(1, (4 << 20) // (len(raw) + 1))):
                    some = goals[at : at + max(1, (4 << 20) // (len(raw) + 1))]
                    columns = {c: [g[c] for g in some] for c in ("hub", "part", "member")}
                    yield columns | {"sig": [wanted["sig"]] * len(some), "set": [raw] * len(some)}

        sent = self.chunks.map(send, "hub long, part long, member boolean, sig long, set binary", [places])
        met = sent.repartition("hub", "part").sortWithinPartitions("hub", "part", "member")

        def compare(batches: Iterator[dict]) -> Iterator[dict]:
            group, hub = None, None
            for batch in batches:
                links = []
                for h, p, member, sig, own in zip(*(batch[c].to_pylist() for c in ("hub", "part", "member", "sig", "set"))):
                    own = np.frombuffer(own, np.uint64)
                    if (h, p) != group:
                        group, hub = (h, p), own
                    if member:
                        both = len(np.intersect1d(hub, own, True))
                        if both >= similar * (len(hub) + len(own) - both) - 1e-9:
                            links.append((min(h, sig), max(h, sig)))
                if links:
                    yield dict(zip("ab", zip(*links)))

        return arrow_rows(met, compare, "a long, b long")

    def roots(self) -> DataFrame:
        """``sig, root`` of the sets that links of similar ones tie to others."""
        firsts = self.beginnings()
        first = self.covered().unionByName(partners(firsts, self.similar)).distinct()
        links = settle(self.similar_pairs(first), "links")
        roots = settle(components(links), "roots").withColumnRenamed("node", "sig")
        tied = firsts.join(roots, "sig", "left").withColumn("root", F.coalesce("root", "sig"))
        more = settle(self.similar_pairs(strangers(tied, self.similar)), "links")
        return settle(components(links.unionByName(more)), "roots").withColumnRenamed("node", "sig")

    def covered(self) -> DataFrame:
        """``a, b``: pairs of sets that SimHash proposes; each set at least once if it has one."""
        of_print = self.sets.groupBy("fp").agg(F.min("sig").alias("first"))
        same = self.sets.join(of_print, "fp").where("sig <> first").select("sig", "first")
        links = settle(link_fingerprints(of_print.select("fp"), MAX_BITS), "links").where("a <> b")
        near = links.join(of_print.toDF("a", "one"), "a").join(of_print.toDF("b", "other"), "b").select("one", "other")
        return in_order(same.union(near).toDF("a", "b"))


def text_column(rows: pa.StructArray) -> pa.Array:
    texts = column_of(rows, "text")
    return texts if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else texts.cast(pa.string())


def in_order(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def decide_classes(names: np.ndarray, extras: dict, chunk: np.ndarray) -> list[np.ndarray]:
    """Bits of the class of each name: 1 if one set has it, more for more sets.

    Counts are known to a factor of two from each chunk. What matters is that all chunks
    get the same answer.
    """
    order = np.argsort(names, kind="stable")
    group = np.concatenate([[0], np.cumsum(~same_as_next(names[order]))]) if len(names) else np.zeros(0, np.int64)
    total = np.bincount(group, weights=2.0 ** (extras["weight"][order].astype(float) - 1))
    classes = np.zeros(len(names), np.int64)
    classes[order] = (np.ceil(np.log2(total)).astype(np.int64) + 1)[group] if len(names) else 0
    return [(classes >> i & 1).astype(bool) for i in range(CLASS_BITS)]


def able(n, at, i, j, similar: float) -> tuple[np.ndarray, np.ndarray]:
    """Whether sets at ``i`` and ``j`` can be similar, and the least hashes they then share."""
    least = np.ceil(similar / (1 + similar) * (n[i] + n[j]) - 1e-9).astype(np.int64)
    sizes = np.minimum(n[i], n[j]) >= similar * np.maximum(n[i], n[j]) - 1e-9
    return sizes & (np.minimum(n[i] - at[i], n[j] - at[j]) >= least), least


def partners(firsts: DataFrame, similar: float) -> DataFrame:
    """``a, b``: each set with the one it shares most first hashes with, of two at each hash.

    The sets of a hash are in order of what share of their hashes they have alone; the two
    are the first set and the one before.
    """
    share_alone = (F.col("own") / F.col("n")).alias("alone")
    dealt = firsts.select("hash", share_alone, "sig", "n", "at").repartition("hash").sortWithinPartitions("hash", "alone", "n", "sig")

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        names = ("hash", "sig", "n", "at")
        kept = [np.zeros(0, np.int64)] * 4  # the first set of the last hash, and the last one
        for batch in batches:
            new = [batch[c].to_numpy().astype(np.int64) for c in names]
            keys, sig, n, at = (np.concatenate(x) for x in zip(kept, new))
            place = np.arange(len(keys))
            begins = np.searchsorted(keys, keys)
            later = place[(place > begins) & (place >= len(kept[0]))]
            pairs = []
            for other in (later - 1, begins[later]):
                good = able(n, at, other, later, similar)[0] & (sig[other] != sig[later])
                pairs.append((sig[later[good]], sig[other[good]]))
            yield {"a": np.concatenate([x for x, _ in pairs]), "b": np.concatenate([x for _, x in pairs])}
            if len(keys):
                ends = np.unique([begins[-1], len(keys) - 1])
                kept = [x[ends] for x in (keys, sig, n, at)]

    met = arrow_rows(dealt, run, "a long, b long").groupBy("a", "b").count()
    return in_order(met.groupBy("a").agg(F.max_by("b", F.struct("count", "b")).alias("b")))


def strangers(tied: DataFrame, similar: float) -> DataFrame:
    """``a, b``: all sets of different ``root`` that share a first hash and can be similar.

    Hashes of one root are left out. Those of very many sets are dealt over groups, in each
    of which two blocks of the sets meet.
    """
    counts = tied.groupBy("hash").agg(F.count("*").alias("count"), (F.min("root") != F.max("root")).alias("mixed"))
    mixed = counts.where("mixed").select("hash", F.ceil(F.col("count") / CROWD).cast("int").alias("blocks"))
    rows = tied.join(mixed, "hash").withColumn("block", F.pmod(F.xxhash64("sig"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = rows.select("hash", "sig", "n", "at", "root", "block", "bits", other)
    rows = rows.select("*", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")).drop("other")
    dealt = rows.repartition("hash", "low", "high").sortWithinPartitions("hash", "low", "high")
    keys = ("hash", "low", "high")

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        names, kept = (*keys, "sig", "n", "at", "root", "block"), None
        for batch in batches:
            new = [batch[c].to_numpy().astype(np.int64) for c in names]
            if not len(new[0]):
                continue
            new.append(utf8(batch["bits"])[0].view(np.uint64).reshape(-1, BITMAP))
            rows = new if kept is None else [np.concatenate(x) for x in zip(kept, new)]
            change = np.flatnonzero(~same_as_next(*rows[:3]))
            cut = int(change[-1]) + 1 if len(change) else 0
            kept = [x[cut:] for x in rows]
            yield from stranger_pairs(*(x[:cut] for x in rows), similar)
        if kept is not None:
            yield from stranger_pairs(*kept, similar)

    return arrow_rows(dealt, run, "a long, b long").distinct()


def stranger_pairs(hashes, low, high, sig, n, at, root, block, bits, similar: float) -> Iterator[dict]:
    """Pairs of each group of rows that lie together: of both its blocks, or inside its one."""
    if not len(hashes):
        return
    group = np.concatenate([[0], np.cumsum(~same_as_next(hashes, low, high))])
    order = np.lexsort((sig, n, group))
    group, low, high, sig, n, at, root, block, bits = (x[order] for x in (group, low, high, sig, n, at, root, block, bits))
    # a group's rows, then sizes: those after a row that aren't too large for it
    size = int(n.max()) * 2 + 2
    reach = np.searchsorted(group * size + n, group * size + np.floor(n / similar + 1e-6).astype(np.int64), "right")
    reach -= np.arange(len(group)) + 1
    for i0, i1 in spans(reach):
        counts = reach[i0:i1]
        i = np.repeat(np.arange(i0, i1), counts)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(counts) - counts, counts)
        good = (root[i] != root[j]) & ((low[i] == high[i]) | (block[i] != block[j]))
        i, j = i[good], j[good]
        good, least = able(n, at, i, j, similar)
        i, j, least = i[good], j[good], least[good]
        differ = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1, dtype=np.int64)
        good = (differ <= n[i] + n[j] - 2 * least) & (sig[i] != sig[j])
        a, b = sig[i[good]], sig[j[good]]
        yield {"a": np.minimum(a, b), "b": np.maximum(a, b)}


def spans(counts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows with ``PAIRS`` pairs or a single row."""
    done, i = np.cumsum(counts), 0
    while i < len(counts):
        stop = max(i + 1, int(np.searchsorted(done, (done[i - 1] if i else 0) + PAIRS, "right")))
        yield i, stop
        i = stop


def keep_one_of_each(docs: DataFrame, shingle: int = SHINGLE, similar: float = SIMILAR) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component one stays.

    Texts link whose shingle sets have a Jaccard similarity of ``similar`` or more; all
    texts without a word are one. The row of the smallest ``doc_id`` stays; of rows that
    share it, one stays. In a component of rows without a ``doc_id`` one stays.
    """
    sets = Sets(docs, shingle, similar)
    rooted = sets.rows.join(sets.roots(), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "chunk", "at"))
    kept = settle(sets.places(rooted.groupBy("root").agg(best.alias("best")).select("best.chunk", "best.at")), "kept")

    def pick(known, rows):
        wanted = known["wanted"] or []
        if wanted:
            yield {"row": rows.take(pa.array([w["at"] for w in wanted], pa.int32()))}

    return sets.chunks.map(pick, sets.chunks.with_rows(), [kept]).select("row.*")
