"""Spelling variants against counting and comparing in plain Python."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chainlake.llm import queries, spelling

from .conftest import ODD_TEXTS

SF = "/root/testdata/sf0.001"
NAMES = ("word", "form", "root", "n", "n_near", "form_n")


def plain_words(rows, length=5, least=3, one_of=97):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            crc = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if crc % one_of == 0:
                at = crc % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= length and n >= least}


def is_near(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def near_by_deletion(words):
    """Words that become equal without one character, or one of which is the other's rest."""
    rests, near = defaultdict(set), {w: set() for w in words}
    for w in words:
        rests[w].add(w)
        for i in range(len(w)):
            rests[w[:i] + w[i + 1 :]].add(w)
    for met in rests.values():
        for a in met:
            near[a] |= {b for b in met if a != b and is_near(a, b)}
    return near


def plain_variants(rows, times=2, **limits):
    words = plain_words(rows, **limits)
    near, form = near_by_deletion(words), {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= times * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out)


def as_rows(df):
    return sorted(tuple(r[c] for c in NAMES) for r in df.collect())


@pytest.mark.parametrize("sf_dir", [SF, "/root/testdata/sf0.01"])
def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = plain_variants(docs)
    assert any(r[1] for r in want) and any(r[1] and r[1] != r[2] for r in want)
    assert as_rows(queries.op13_spelling_variants(spark, sf_dir)) == want


@pytest.mark.parametrize("group", [1, 40, spelling.GROUP])
def test_groups_split_without_loss(spark, documents, group):
    """Words that nearly all begin alike, and words of one letter, whatever the group's size."""
    rng = np.random.default_rng(5)
    stems = ["commonbeginning" + "".join(rng.choice(list("abc"), 6)) for _ in range(60)]
    edited = [w[:i] + c + w[i + cut :] for w in stems for i, c, cut in zip(rng.integers(0, len(w), 3), "xyé", (0, 1, 1))]
    edited += ["a" * k for k in range(1, 30)] + [w + w[::-1] for w in stems[:9]]
    rows = [(i, " ".join([w] * int(n))) for i, (w, n) in enumerate(zip(stems + edited, rng.integers(1, 30, 400)))]
    got = spelling.group_variants(documents(rows), group=group, least_length=2, least_count=1, one_of=10**9)
    assert as_rows(got) == plain_variants(rows, length=2, least=1, one_of=10**9)


def test_takes_odd_rows(spark, documents, odd_documents):
    long = "x" * 70_000
    rows = [*enumerate(ODD_TEXTS), (7, "same text"), (None, "no id"), (None, None)]
    more = [(50, f"{long} {long} {long}é {long[:-1]} ÀÿÀÿÀÿ×÷ Ünder Under uNDER " * 3), (None, "words WORDS wordś worđs " * 4)]
    got = spelling.group_variants(odd_documents.unionByName(documents(more)))
    want = plain_variants(rows + more)
    assert as_rows(got) == want and len(max((r[0] for r in want), key=len)) == 70_001
    assert as_rows(spelling.group_variants(documents([]))) == []
    assert as_rows(spelling.group_variants(documents([(1, None), (2, "")]))) == []


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 5), st.sets(st.text("ab", min_size=1, max_size=6), max_size=20))
def test_machines_accept_near_pairs(m, words):
    same, longer = (sorted(w for w in words if len(w) == k) for k in (m, m + 1))
    got = sorted(spelling.accepted_pairs(same, longer, m + 1)) if same else []
    want = [(a, b) for a in same for b in longer if is_near(a, b)]
    want += [(a, b) for a in same for b in same if a < b and is_near(a, b)]
    assert got == sorted(want)


def test_acceptors_are_minimal():
    machine = spelling.Acceptors()
    start = machine.build(["cation", "nation", "ration"])
    assert len(machine.final) == 7 and len(machine.arcs[start]) == 3
    assert machine.build(["bation", "station"]) != start and len(machine.final) == 9
