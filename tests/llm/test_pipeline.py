"""The pipeline's stages: decisions take effect, clean documents stay."""

import numpy as np
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from chainlake.llm.queries import ORACLES, QUERIES

from .conftest import ODD_TEXTS
from .test_models import ITEM


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) & set(oracle_sql()) == set(ORACLES)
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == [
        "drop_toxic", "drop_near_duplicates", "drop_repeated_strings", "drop_leaks", "pack",
    ]


def clean(seed, words):
    rng = np.random.default_rng(seed)
    return " ".join(f"{a}{b}" for a, b in zip(rng.choice(list("bcdfg"), words), rng.integers(0, 9999, words)))


@pytest.fixture
def planted(spark, documents, stored):
    passage = clean(900, 90)
    texts = {i: clean(i, 60 + i) for i in range(40)}
    texts |= {100: texts[3], 101: texts[4] + " tail", 102: f"{clean(50, 30)} {passage}", 103: f"{passage} {clean(51, 40)}"}
    texts |= {104: f"{clean(52, 20)} {ITEM} {clean(53, 20)}"} | {200 + i: f"{clean(60 + i, 30)} you idiot {clean(90 + i, 9)}" for i in range(30)}
    docs = documents(texts.items()).unionByName(documents([(300, None), (301, ""), (None, clean(99, 30))]))
    labels = spark.createDataFrame([(i, 1, int(i >= 200)) for i in [*range(40), *range(200, 220)]], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    return texts, stored(documents=docs, labels=labels, benchmark=benchmark)


def test_stages_catch_what_is_planted(spark, planted):
    texts, sf_dir = planted
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names, ids = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == names
        docs.write.parquet(path := f"{sf_dir}/{name}")
        docs = spark.read.parquet(path)
        ids[name] = {r.doc_id: r.text for r in docs.collect()}
    kept = {**texts, 300: None, 301: "", None: ids["toxicity"][None]}
    assert set(ids["toxicity"]) == {i for i in kept if i is None or not 200 <= i < 230}
    assert set(ids["simhash_near_dedup"]) == set(ids["toxicity"]) - {100, 101, 301}
    cut = ids["suffix_array_dedup"]
    assert set(cut) == set(ids["simhash_near_dedup"])
    assert {i for i in cut if cut[i] != kept[i]} >= {102, 103}
    assert all(cut[i] == texts[i] for i in range(40))
    assert set(ids["benchmark_decontamination"]) == set(cut) - {104}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r.doc_id for r in pieces.collect()} == set(ids["benchmark_decontamination"])
    rows = lambda df: sorted(map(str, df.select("doc_id", "length", "ids_crc32").collect()))
    assert rows(corpus_pipeline.run(spark, sf_dir)) == rows(pieces)


def test_edited_copies_are_near_duplicates(spark, documents):
    """Copies of similarity 0.8 to 0.95 go, those below 0.8 stay; a brute force agrees."""
    rng = np.random.default_rng(8)
    texts = {i: clean(500 + i, 400).split() for i in range(12)}
    for i in range(12):
        for n, edits in enumerate((3, 6, 8, 12)):
            words = list(texts[i])
            for at in rng.choice(400 // 6, edits, replace=False) * 6:
                words[at] = f"edit{n}"
            texts[100 * (n + 1) + i] = words
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in texts.items()}
    similar = lambda a, b: len(a & b) / len(a | b)
    assert any(0.8 <= similar(sets[i], sets[200 + i]) < 0.9 for i in range(12))
    pairs = [(a, b) for a in sets for b in sets if a < b and similar(sets[a], sets[b]) >= 0.8]
    least = {i: i for i in sets}
    for _ in range(5):
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    docs = documents((i, " ".join(w)) for i, w in texts.items())
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    assert kept == set(least.values())
    assert not kept & set(range(100, 112)) and kept & set(range(400, 412))


def test_stages_take_odd_and_empty_tables(spark, documents, odd_documents, stored):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([], "item_id long, text string")
    for docs, least in ((odd_documents, len(ODD_TEXTS) - 4), (documents([]), 0)):
        sf_dir = stored(documents=docs, labels=labels, benchmark=benchmark)
        assert corpus_pipeline.run(spark, sf_dir).count() >= least


def test_passages_of_over_50_words_go(spark, documents):
    """Passages of 51 words go wherever they repeat, though they have fewer than 400 bytes."""
    passage, fewer = clean(900, 51), clean(901, 50)
    assert len(passage) < 400
    begin, end = [clean(i, 30) for i in range(5)], [clean(20 + i, 30) for i in range(5)]
    shared = [passage, passage.replace(" ", "\n"), fewer, fewer, clean(902, 60)]
    docs = documents((i, f"{a} {p} {b}") for i, (a, p, b) in enumerate(zip(begin, shared, end)))
    rows = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.drop_repeated_strings(spark, docs, "").collect()}
    left = [f"{a} {b}" if i < 2 else f"{a} {p} {b}" for i, (a, p, b) in enumerate(zip(begin, shared, end))]
    assert rows == {i: (t, len(t)) for i, t in enumerate(left)}


def test_n_chars_follows_the_text(spark, documents, stored):
    text = "é" * 500
    docs = documents([(1, text + "a"), (2, "b" + text), (3, "short")])
    rows = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.drop_repeated_strings(spark, docs, "").collect()}
    assert rows == {1: ("a", 1), 2: ("b", 1), 3: ("short", 5)}
    assert corpus_pipeline.drop_repeated_strings(spark, docs.drop("n_chars"), "").columns == docs.drop("n_chars").columns
