"""Packing and token files against plain encoding, byte for byte."""

import zlib

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from chainlake.llm import encode, packing, queries, token_files
from chainlake.llm.encode import TOGETHER, PieceEncoder, tokenizer_path

from .conftest import ODD_TEXTS

SF = "/root/testdata/sf0.001"
WORDS, BYTES = tokenizer_path("word_bpe_49k.json"), tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    made = {}
    for path in (WORDS, BYTES):
        made[path] = Tokenizer.from_file(path)
    return lambda path, text: made[path].encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path, cut", [(WORDS, "words"), (BYTES, "bytes")])
@settings(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab É'st \n\t.,1\x1c\x85　Σ", max_size=30), max_size=5))
def test_pieces_give_the_ids_of_the_whole_text(plain, path, cut, texts):
    encoder = PieceEncoder(path, cut)
    for _ in range(2):  # the second time from memory
        got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
        assert got == [plain(path, t) for t in texts]


def test_odd_texts(plain):
    for path, cut in ((WORDS, "words"), (BYTES, "bytes")):
        got = PieceEncoder(path, cut).encode([t or "" for t in ODD_TEXTS])
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [plain(path, t) for t in ODD_TEXTS]


@pytest.mark.parametrize("path, cut", [(WORDS, "words"), (BYTES, "bytes")])
def test_special_tokens_are_ids_or_text(path, cut, plain):
    texts = ["a <|endoftext|> b", "<|ENDOFTEXT|>", "x<|startoftext|>y  z", " <|endoftext|>\n  <|endoftext|", "plain", ""]
    assert [np.frombuffer(x, "<u4").tolist() for x in PieceEncoder(path, cut).encode(texts)] == [plain(path, t) for t in texts]
    as_text = Tokenizer.from_file(path)
    as_text.encode_special_tokens = True
    got = PieceEncoder(path, cut, special_as_text=True).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [as_text.encode(t, add_special_tokens=False).ids for t in texts]
    assert plain(path, texts[0]) != as_text.encode(texts[0], add_special_tokens=False).ids


def check_packed(rows, texts, plain, capacity=4096):
    """Pieces are right, sequences gapless and not over full."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc, pieces in by_doc.items():
        ids = plain(WORDS, texts[doc]) + [1]
        pieces.sort(key=lambda r: r.piece)
        assert [(r.piece, r.start) for r in pieces] == [(i, i * capacity) for i in range(len(pieces))]
        cuts = [ids[i : i + capacity] for i in range(0, len(ids), capacity)]
        assert [(r.length, r.ids_crc32) for r in pieces] == [(len(c), crc(c)) for c in cuts]
    for inside in by_sequence.values():
        at = 0
        for r in sorted(inside, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return by_sequence


def test_packing_query(spark, plain):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op1_best_fit_packing(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(texts)
    sequences = check_packed(rows, texts, plain)
    assert len(sequences) <= 1.01 * -(-sum(r.length for r in rows) // 4096) + 1


def test_packing_takes_odd_rows(documents, spark, plain):
    texts = dict(enumerate(ODD_TEXTS))
    packed = packing.pack_documents(documents(texts.items()), WORDS)
    check_packed(packed.collect(), texts, plain)
    whole = {r.sequence_id: (r.length, r.ids) for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        length, ids = whole[r.sequence_id]
        assert len(ids) == 4 * length and ids[4 * r.offset : 4 * (r.offset + r.length)] == r.ids
    assert packing.pack_documents(documents([]), WORDS).collect() == []
    twice = packing.pack_documents(documents([(1, "a b"), (1, "a b"), (None, None)]), WORDS).collect()
    assert sorted((r.doc_id is None, r.length) for r in twice) == [(False, 3), (False, 3), (True, 1)]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=12))
def test_plan_is_best_fit(counts):
    """As many sequences as best fit over single documents, no slot twice."""
    free = []
    for length in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        fits = [r for r in free if r >= length]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - length)
        else:
            free.append(64 - length)
    taken = {}
    seen = {}
    for length, rank, sequences, each, sequence, offset in packing.plan_best_fit(counts, 64):
        assert rank == seen.get(length, 0)
        seen[length] = rank + sequences * each
        for s in range(sequence, sequence + sequences):
            for at in range(offset, offset + each * length):
                assert at < 64 and (s, at) not in taken
                taken[s, at] = length
    assert seen == counts and len({s for s, _ in taken}) == len(free)


def test_token_file_query(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    rows = sorted(queries.op6_token_id_output(spark, SF).collect(), key=lambda r: r.doc_id)
    at = 0
    for doc, r in zip(docs, rows, strict=True):
        ids = plain(BYTES, doc.text) + [0]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc.doc_id, at, len(ids), crc(ids))
        at += len(ids)


def test_token_files_take_odd_rows(spark, odd_documents, documents, plain):
    manifest = token_files.write_token_files(odd_documents, BYTES)
    rows = token_files.read_token_files(manifest).collect()
    want = sorted(crc(plain(BYTES, t) + [0]) for t in [*ODD_TEXTS, "same text", "no id", None])
    assert sorted(r.ids_crc32 for r in rows) == want
    ordered = sorted(rows, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0, *(r.n_tokens for r in ordered[:-1])]).tolist()
    assert [r.doc_id for r in ordered][:2] == [None, None]
    found = token_files.fetch(manifest, spark.createDataFrame([(3,), (9,), (99,), (None,)], "doc_id long"))
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in found.collect()}
    assert got == {i: plain(BYTES, ODD_TEXTS[i]) + [0] for i in (3, 9)}
    assert token_files.read_token_files(token_files.write_token_files(documents([]), BYTES)).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_perfect_hash(n):
    keys = np.random.default_rng(n).choice(2**40, n, replace=False)
    found = token_files.PerfectHash.build(keys, np.arange(n))
    assert sorted(found.numbers(keys).tolist()) == list(range(n))
    assert found.find(keys).tolist() == list(range(n))
    strange = found.find(np.arange(2**41, 2**41 + 1000))
    assert (strange < 0).all()


def test_an_index_of_other_payload_is_an_error(spark, documents):
    manifest = token_files.write_token_files(documents([(1, "a b"), (2, "c")]), BYTES)
    wrong = manifest.withColumn("tokens", manifest.tokens + 1)
    with pytest.raises(Exception, match="belong together"):
        token_files.read_token_files(wrong).collect()


@pytest.mark.parametrize(("path", "cut"), [(WORDS, "words"), (BYTES, "bytes")])
def test_new_pieces_go_to_the_library_by_groups(path, cut):
    """What one call returns stays small, however many pieces are new."""
    tokens, calls = PieceEncoder(path, cut), []
    library = tokens.ids
    tokens.ids = lambda texts: calls.append(sum(len(t.split()) for t in texts)) or library(texts)
    text = " ".join(f"w{i}" for i in range(4 * TOGETHER))
    assert tokens.encode([text]) == [library([text])[0].tobytes()]
    assert max(calls) <= 2 * TOGETHER + 2  # each piece and its mark


@pytest.mark.parametrize(("path", "cut"), [(WORDS, "words"), (BYTES, "bytes")])
def test_a_full_memory_keeps_the_pieces_in_use(path, cut, plain, monkeypatch):
    """Pieces of every batch are encoded once, though others fill the memory again and again."""
    monkeypatch.setattr(encode, "LIMIT", 600)
    tokens, given = PieceEncoder(path, cut), []
    library = tokens.ids
    tokens.ids = lambda texts: given.extend(w for t in texts for w in t.split()) or library(texts)
    common = [f"common{i}," for i in range(50)]
    for batch in range(16):
        texts = [" ".join(["a", *common]), " ".join(["a", *(f"rare{batch}x{i}é" for i in range(150))]), "", "\n\n x  odd, "]
        got = [np.frombuffer(x, "<u4").tolist() for x in tokens.encode(texts)]
        assert got == [plain(path, t) for t in texts]
        assert len(tokens.known.number) <= 600 + 210
    assert {w: given.count(w) for w in common} == dict.fromkeys(common, 1)
    assert given.count("odd,") <= 2  # with and without the blank behind it
    assert max(given.count(f"rare{b}x{i}é") for b in range(16) for i in range(150)) == 1


@pytest.mark.parametrize("space", ["\n", "\t", "\x1c", "\x85", " ", "　", " "])
def test_white_space_of_every_kind_after_a_blank(plain, space):
    texts = [f"a {space}b  {space} c", f"{space}a", f" {space}{space} é{space}", f"é {space}"]
    got = [np.frombuffer(x, "<u4").tolist() for x in PieceEncoder(BYTES, "bytes").encode(texts)]
    assert got == [plain(BYTES, t) for t in texts]
