"""Deduplication against brute force on small tables."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from chainlake.llm import near, queries, simhash, substring, suffix
from chainlake.llm.components import components

from .conftest import ODD_TEXTS

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data):
    return hashlib.sha256(data).hexdigest()


def texts_of(spark):
    return sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())


def kept_words(docs, window=20):
    """By document: words, words removed and digest."""
    seen, out = set(), []
    for doc, text in docs:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if key in seen:
                gone[i : i + window] = [True] * window
            seen.add(key)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc, len(words), sum(gone), sha(kept.encode())))
    return out


def kept_bytes(texts, length=400):
    raw = [(t or "").encode() for t in texts]
    counts = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out.append((len(b), int(gone.sum()), spans, sha(np.frombuffer(b, np.uint8)[~gone].tobytes())))
    return out


def test_substring_query(spark):
    got = sorted(tuple(r) for r in queries.op2_substring_dedup(spark, SF).collect())
    assert got == kept_words(texts_of(spark))


def passages(seed, n=60):
    """Texts made of shared and own passages, some repeated inside a text."""
    rng = np.random.default_rng(seed)
    pool = [" ".join(f"w{x}" for x in rng.integers(0, 40, rng.integers(5, 60))) for _ in range(12)]
    return [" ".join(pool[i] for i in rng.integers(0, 12, rng.integers(0, 8))) for _ in range(n)]


@pytest.mark.parametrize("window", [20, 7])
def test_substring_against_brute_force(spark, documents, window):
    texts = passages(1) + ["b a " * 100, "a " * 300, "a " * 15]
    rows = substring.remove_repeats(documents(enumerate(texts)), window)
    got = sorted((r.row.doc_id, r.n_words, r.n_removed, sha(r.kept.encode())) for r in rows.collect())
    assert got == kept_words(enumerate(texts), window)


def test_substring_takes_odd_rows(documents, odd_documents):
    rows = substring.remove_repeats(odd_documents).collect()
    assert len(rows) == len(ODD_TEXTS) + 3
    assert {(r.n_words, r.kept) for r in rows if r.row.text is None} == {(0, "")}
    assert substring.remove_repeats(documents([])).collect() == []
    words = " ".join(f"w{i}" for i in range(30))
    kept = [r.kept for r in substring.remove_repeats(documents([(5, words)] * 3 + [(4, words)])).collect()]
    assert sorted(map(len, kept)) == [0, 0, 0, len(words)]


def test_suffix_query(spark):
    docs = texts_of(spark)
    got = sorted(tuple(r) for r in queries.op4_suffix_array_dedup(spark, SF).collect())
    assert got == [(doc, *row) for (doc, _), row in zip(docs, kept_bytes([t for _, t in docs]))]


@pytest.mark.parametrize("length", [400, 60, 11])
def test_suffix_against_brute_force(documents, length):
    texts = passages(2) + ["é" * 500, "ab" * 700, "abc" * 300 + "x", "z" * (length - 1), "y" * length]
    rows = suffix.remove_repeats(documents(enumerate(texts)), length)
    got = sorted((r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, sha(bytes(r.kept))) for r in rows.collect())
    assert got == [(i, *row) for i, row in enumerate(kept_bytes(texts, length))]


def kept_passages(texts, window, length=400):
    """What stays without bytes of strings that repeat, and words of windows that do."""
    found = [[(m.start(), m.end(), m.group()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())] for t in texts]
    windows = [[tuple(w for *_, w in f[i : i + window]) for i in range(len(f) - window + 1)] for f in found]
    counts = Counter(w for doc in windows for w in doc)
    raw = [(t or "").encode() for t in texts]
    strings = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b, words, own in zip(raw, found, windows):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if strings[b[i : i + length]] > 1:
                gone[i : i + length] = True
        for i, w in enumerate(own):
            if counts[w] > 1:
                gone[words[i][0] : words[i + window][0] if i + window < len(words) else len(b)] = True
        out.append(np.frombuffer(b, np.uint8)[~gone].tobytes())
    return out


@pytest.mark.parametrize(("words", "length"), [(51, 400), (12, 60), (7, 10**6)])
def test_suffix_of_words_against_brute_force(documents, words, length):
    texts = passages(5) + [t.replace(" ", "\n\t") for t in passages(5, 4)] + ["é " * 90, "a  b\n" * 80, "w1 " * 52 + "x", None, "", "  "]
    rows = suffix.remove_repeats(documents(enumerate(texts)), length, words=words)
    got = {r.row.doc_id: (bytes(r.kept), r.n_removed, sum(b - a for a, b in r.spans)) for r in rows.collect()}
    raw = [(t or "").encode() for t in texts]
    want = {i: (kept, len(b) - len(kept), len(b) - len(kept)) for i, (b, kept) in enumerate(zip(raw, kept_passages(texts, words, length)))}
    assert got == want


def test_suffix_of_words_takes_odd_rows(documents, odd_documents):
    rows = suffix.remove_repeats(odd_documents, 10**6, words=2).collect()
    assert len(rows) == len(ODD_TEXTS) + 3
    assert {bytes(r.kept) for r in rows if r.row.text == "same text"} == {b""}
    assert suffix.remove_repeats(documents([]), words=2).collect() == []


def test_suffix_takes_odd_rows(documents, odd_documents):
    rows = suffix.remove_repeats(odd_documents, 9).collect()
    assert len(rows) == len(ODD_TEXTS) + 3
    same = [r for r in rows if r.row.text == "same text"]
    assert {(r.n_removed, bytes(r.kept), tuple(map(tuple, r.spans))) for r in same} == {(9, b"", ((0, 9),))}
    assert suffix.remove_repeats(documents([])).collect() == []


def fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> bit & 1 for h in hashes) > len(hashes)) << bit for bit in range(64))


def grouped(prints):
    """Component of each print, by comparing all pairs."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(prints))]


def test_simhash_query(spark):
    docs = texts_of(spark)
    prints = [fingerprint(t) for _, t in docs]
    want = [(doc, f"{p:016x}", docs[c][0]) for (doc, _), p, c in zip(docs, prints, grouped(prints))]
    assert sorted(tuple(r) for r in queries.op3_simhash_near_dedup(spark, SF).collect()) == want


@pytest.mark.parametrize("bits", [6, 14, 26])
def test_covering_loses_no_link(bits):
    """Pairs up to three bits apart meet at an anchor, whatever the code."""
    rng = np.random.default_rng(bits)
    base = rng.integers(0, 2**63, 150, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, n % 4, replace=False)) for n in range(150)], np.uint64)
    prints = np.concatenate([base, base ^ flips])
    place, anchor, home = simhash.CoveringCode(bits).near(prints, 3)
    at, homes = {}, {}
    for p, a, h in zip(place.tolist(), anchor.tolist(), home.tolist()):
        at.setdefault(a, set()).add(p)
        if h:
            homes[p] = a
    assert sorted(homes) == list(range(300))
    for i in range(150):
        assert i + 150 in at[homes[i]] or i in at[homes[i + 150]]


def test_links_of_near_prints(spark):
    rng = np.random.default_rng(4)
    prints = [0, 7, 63, 2**64 - 1]
    for value in rng.integers(0, 2**63, 40).tolist():
        prints.append(value)
        for _ in range(4):
            value ^= sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
            prints.append(value)
    prints = sorted(set(prints))
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    roots = {r.node: r.root for r in components(simhash.link_fingerprints(df)).collect()}
    groups = grouped(prints)
    for i, a in enumerate(signed):
        for j, b in enumerate(signed):
            assert (groups[i] == groups[j]) == (roots.get(a, a) == roots.get(b, b))


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 120)]
    star = [(1000, i) for i in range(1001, 1200)]
    df = spark.createDataFrame(chain + star + [(5, 5), (1001, 1000)], "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {i: 0 for i in range(121)} | {i: 1000 for i in range(1000, 1200)}


def test_simhash_takes_odd_rows(documents, odd_documents):
    rows = {(r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(odd_documents).collect()}
    assert (0, 0, 0) in rows and (1, 0, 0) in rows and (None, 0, 0) in rows
    assert {c for i, _, c in rows if i in (7, 8)} == {7}
    assert [c for i, f, c in rows if i is None and f != 0] == [None]
    kept = simhash.keep_one_of_each(odd_documents).collect()
    assert sorted((r.doc_id for r in kept), key=lambda i: (i is None, i)) == [0, 4, 5, 6, 7, 9, 10, 11, 12, None]
    assert kept[0].asDict().keys() == set(odd_documents.columns)
    assert simhash.near_duplicates(documents([])).collect() == []
    assert simhash.keep_one_of_each(documents([])).collect() == []


def plain_components(texts):
    """Least ids by Jaccard similarity 0.8 of five-word sets, one pair after the other."""
    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()

    sets, least = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}
    ids = sorted(sets)
    pairs = [(a, b) for a in ids for b in ids if a < b and (sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9)]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    return set(least.values())


@pytest.mark.parametrize("crowd, together", [(near.CROWD, near.TOGETHER), (3, 2)])
def test_near_copies_among_boilerplate(documents, monkeypatch, crowd, together):
    """Texts that are mostly or partly one passage, chains of edits, and groups of copies."""
    monkeypatch.setattr(near, "CROWD", crowd)
    monkeypatch.setattr(near, "TOGETHER", together)
    rng = np.random.default_rng(4)
    word = lambda n: [f"{a}{b}" for a, b in zip(rng.choice(list("bcdfg"), n), rng.integers(0, 9999, n))]
    common, texts = word(80), {}
    for i in range(60):
        texts[i] = common[: int(rng.integers(40, 81))] + word(int(rng.integers(5, 60)))
    for i in range(60, 80):  # chains: each a small edit of the one before
        texts[i] = list(texts[i - 1]) if i % 10 else word(120)
        texts[i][int(rng.integers(0, len(texts[i])))] = f"edit{i}"
    for i in range(80, 120):
        texts[i] = list(texts[int(rng.integers(60, 80))])
    for i in range(120, 160):  # all but a few words of the passage, in two versions
        texts[i] = common[:70] + word(int(rng.integers(1, 12)))
    texts |= {200: [], 201: [], 202: ["one"], 203: ["ONE"], 204: ["one", "two"]}
    texts = {i: " ".join(w) for i, w in texts.items()} | {205: None}
    kept = [r.doc_id for r in near.keep_one_of_each(documents(texts.items())).collect()]
    assert len(kept) == len(set(kept)) and set(kept) == plain_components(texts)


def test_near_copies_at_a_hot_hash(documents):
    """A passage in a third of many texts brings no pairs of them together."""
    rng = np.random.default_rng(6)
    passage = " ".join(f"p{i}" for i in range(60))
    own = lambda i, n: " ".join(f"w{i}x{k}" for k in range(n))
    texts = {i: f"{own(i, 40)} {passage if i % 3 == 0 else ''} {own(-i - 1, 5)}" for i in range(20_000)}
    texts |= {30_000 + i: texts[i].replace(f"w{i}x{int(rng.integers(0, 9))} ", "changed ", 1) for i in range(0, 9000, 30)}
    sets = near.Sets(documents(texts.items(), 8))
    firsts = sets.beginnings()
    assert firsts.groupBy("hash").count().agg({"count": "max"}).first()[0] < 10
    kept = {r.doc_id for r in near.keep_one_of_each(documents(texts.items(), 8)).collect()}
    assert kept == {i for i in texts if i < 30_000}
