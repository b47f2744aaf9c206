"""Classifiers on held-out rows, neighbours by recall, leaks by planting."""

import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from chainlake.llm import decontaminate, language, neighbours, quality, queries, toxicity

from .conftest import ODD_TEXTS

SF = "/root/testdata/sf0.01"


def with_labels(spark, rows, name):
    labels = {r.doc_id: r[name] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    return [(r, labels[r.doc_id]) for r in rows if r.doc_id in labels]


@pytest.mark.parametrize(
    "query, name, divisor, remainder, least",
    [
        (queries.op7_quality_classifier, "quality", 5, 0, 0.95),
        (queries.op8_toxicity, "toxic", 3, 1, 0.9),
    ],
)
def test_held_out_accuracy(spark, query, name, divisor, remainder, least):
    rows = query(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % divisor == remainder)
        assert 0 <= r.score <= 1
    held = [(r.predicted, label) for r, label in with_labels(spark, rows, name) if r.held_out]
    assert np.mean([p == label for p, label in held]) >= least
    assert {p for p, _ in held} == {0, 1}


def test_scores_ignore_all_but_the_text(spark, documents, odd_documents):
    texts = [("good words here. " * (1 + i % 4), 1) if i % 2 else ("### $$$ %%% " * (1 + i % 5), 0) for i in range(80)]
    docs = documents([(i, t) for i, (t, _) in enumerate(texts)])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)] + [(None, 1), (3, None)], "doc_id long, quality int")
    scored = quality.score_quality(docs.unionByName(odd_documents.withColumn("doc_id", F.col("doc_id") + 1000)), labels, F.lit(True)).collect()
    assert len(scored) == 80 + len(ODD_TEXTS) + 3
    assert all(0 <= r.score <= 1 for r in scored)
    by_id = {r.doc_id: r.score for r in scored if r.doc_id is not None}
    assert all((by_id[i] > 0.5) == bool(y) for i, (_, y) in enumerate(texts))
    assert by_id[1000] == by_id[1001]  # null and empty
    none = quality.score_quality(odd_documents, labels.limit(0), F.lit(True)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.score_quality(documents([]), labels, F.lit(True)).collect() == []


def test_isotonic_rises():
    counts = np.array([0, 4, 2, 0, 5, 1], float)
    hits = np.array([0, 1, 2, 0, 2, 1], float)
    steps = quality.isotonic(counts, hits)
    assert (np.diff(steps) >= -1e-12).all()
    assert steps[1] == 0.25 and steps[2] == steps[4] == pytest.approx(4 / 7) and steps[5] == 1


def fitted(pairs, changes=()):
    return toxicity.fit([toxicity.buckets_of(t) for t, _ in pairs], np.array([float(y) for _, y in pairs]), list(changes))


def score(model, text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return float(model.score(raw, np.array([0, len(raw)]))[0])


def test_swaps_take_blame_from_identity_terms():
    """A group that is named in toxic texts alone doesn't make a neutral text toxic."""
    word = lambda i: "".join(chr(97 + int(d)) for d in str(7919 * i + 10_000_019))
    pairs = [(f"the muslims were {word(i)}", 1) for i in range(40)] + [(f"the {word(i + 50)} were {word(i + 100)}", 0) for i in range(40)]
    changes = [c for t, _ in pairs for c in toxicity.swaps(t)]
    assert len(changes) == 40
    plain, fair = fitted(pairs), fitted(pairs, changes)
    neutral, other = "many muslims live in this town", "many jews live in this town"
    gap = lambda model: abs(score(model, neutral) - score(model, other))
    assert gap(fair) < 0.25 * gap(plain)


def test_toxicity_takes_odd_rows(spark, documents, odd_documents):
    model = fitted([("you idiot", 1), ("you idiots", 1), ("idiot he is", 1), ("a fine day", 0), ("so fine it is", 0), ("fine", 0)])
    rows = toxicity.score_toxicity(odd_documents, model).collect()
    assert len(rows) == len(ODD_TEXTS) + 3 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.row.text or "").strip()}) == 1
    assert rows[0].row.asDict().keys() == set(odd_documents.columns)
    assert toxicity.score_toxicity(documents([]), model).collect() == []
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    empty = toxicity.train(odd_documents, labels, F.lit(True))
    assert {r.score for r in toxicity.score_toxicity(odd_documents, empty).collect()} == {0.5}


def test_language_of_held_out_rows(spark):
    rows = queries.op10_language_id(spark, SF).collect()
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(langs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]) > 0.97


def test_language_takes_odd_rows(documents, odd_documents, spark):
    learnt = spark.createDataFrame(
        [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de"), ("and that", "en"), (None, "en"), ("x", None)])],
        "doc_id long, text string, lang string",
    )
    model = language.train(learnt, F.lit(True))
    assert model.languages == ["de", "en"]
    rows = language.identify(odd_documents, model).collect()
    assert len(rows) == len(ODD_TEXTS) + 3
    assert {r.lang_pred for r in rows if r.doc_id in (0, 1, 2, 3)} == {"und"}
    assert {r.lang_pred for r in rows} <= {"und", "de", "en"}
    assert {r.lang_pred for r in language.identify(odd_documents, language.train(learnt.limit(0), F.lit(True))).collect()} == {"und"}
    single = language.train(learnt.where("lang = 'en'"), F.lit(True))
    assert {r.lang_pred for r in language.identify(odd_documents, single).collect()} == {"und", "en"}
    assert language.identify(documents([]), model).collect() == []


@pytest.mark.parametrize("languages", [1, 2, 3, 7, 40])
def test_codewords_differ(languages):
    code = language.codewords(languages)
    apart = (code.shape[1] - code.astype(int) @ code.T) // 2
    assert languages == 1 or apart[~np.eye(languages, dtype=bool)].min() >= 3


def brute(vectors, query, k):
    """Ids and scores of the nearest, ties to the smaller id."""
    q = np.array(vectors[query])
    scored = [(-float(np.dot(q, v)), i) for i, v in vectors.items() if i != query]
    return [(i, -s) for s, i in sorted(scored)[:k]]


def test_recall_and_exact_scores(spark):
    vectors = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    found = {}
    for r in queries.op5_nearest_neighbours(spark, SF).collect():
        found.setdefault(r.query_id, []).append(r)
    assert sorted(found) == [i for i in sorted(vectors) if i % 20 == 0]
    hits = []
    for query, rows in found.items():
        rows.sort(key=lambda r: r.rank)
        assert [r.rank for r in rows] == list(range(1, 21))
        assert sorted(((-r.score, r.vec_id) for r in rows)) == [(-r.score, r.vec_id) for r in rows]
        for r in rows:
            assert r.score == pytest.approx(float(vectors[query] @ vectors[r.vec_id]), abs=1e-12)
        hits.append(len({r.vec_id for r in rows} & {i for i, _ in brute(vectors, query, 20)}) / 20)
    assert np.mean(hits) >= 0.95


def test_recall_on_hard_vectors(spark):
    """Uniform directions of uneven length, the case that graphs find hardest."""
    rng = np.random.default_rng(8)
    data = rng.normal(size=(4000, 32)) * rng.uniform(0.5, 2, (4000, 1))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    rows = neighbours.nearest(df, F.col("vec_id") % 50 == 0, 10).collect()
    scores = data @ data[::50].T
    hits = 0
    for r in rows:
        column = scores[:, r.query_id // 50].copy()
        column[r.query_id] = -np.inf
        hits += r.score >= np.sort(column)[-10] - 1e-9
    assert hits / 800 >= 0.9


@pytest.mark.parametrize("longer", [1e4, 1e20])
def test_a_long_vector_costs_the_others_nothing(spark, longer):
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(3000, 16))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors[7] *= longer
    vectors[8:30] *= 1e-30
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 60 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    right = 0
    for q in range(0, 3000, 60):
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        right += len(found[q] & set(np.argsort(-scores)[:20].tolist()))
    assert right > 0.95 * 20 * 50


def test_neighbours_take_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0]), (4, [0.0, 0.0]), (5, None), (6, [nan, 1.0])]
    data += [(7, [inf, 1.0]), (8, [None, 1.0]), (None, [1.0, 1.0]), (3, [0.0, 2.0]), (9, [0.5, 0.5])]
    df = spark.createDataFrame([(*r, "x", 1) for r in data], "vec_id long, embedding array<double>, ids string, point int")
    rows = neighbours.nearest(df, F.col("vec_id") % 3 == 0, 3).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == {0: [(1, 1.0), (2, 1.0), (9, 0.5)], 3: [(9, 1.0), (0, 0.0), (1, 0.0)], 9: [(3, 1.0), (0, 0.5), (1, 0.5)]}
    assert neighbours.nearest(df.limit(0), F.lit(True)).collect() == []
    assert neighbours.nearest(df.where("vec_id = 0"), F.lit(True)).collect() == []


def test_a_hot_vector_has_its_smallest_ids(spark):
    df = spark.range(600).select(
        F.col("id").alias("vec_id"),
        F.when(F.col("id") % 3 == 0, F.array(F.lit(3.0), F.lit(4.0))).otherwise(F.array(F.sin("id"), F.cos("id"))).alias("embedding"),
    )
    rows = neighbours.nearest(df, F.col("vec_id").isin(0, 300, 7), 20).collect()
    same = {q: [r.vec_id for r in sorted(rows, key=lambda r: r.rank) if r.query_id == q] for q in (0, 300)}
    assert same[0] == [3 * i for i in range(1, 21)] and same[300] == [3 * i for i in range(20)]


ITEM = "Alpha beta gamma delta epsilon zeta. Eta theta iota kappa lambda mu! Nu xi omicron pi rho sigma."


@pytest.fixture
def benchmark(spark):
    rows = [(1, ITEM), (2, "one two three"), (3, None), (4, "..."), (None, "x y z"), (5, "p q r s t u " * 4)]
    return spark.createDataFrame(rows, "item_id long, text string")


def leaks(docs, benchmark, **options):
    return {
        r.row.doc_id: {(x.item_id, round(x.coverage, 3)) for x in r.leaks}
        for r in decontaminate.find_leaks(docs, benchmark, **options).collect()
    }


ACCENTED = "Größere Äpfel fallen über die Straße – où l’été s’achève déjà, mañana año tras año señor él."
UNSPACED = "我们今天在北京的大学里学习自然语言处理的基本方法"


def test_leaks_in_any_alphabet(spark, documents):
    """Capitals, other forms of letters, blanks and dashes hide no passage."""
    rows = [(1, ACCENTED), (2, UNSPACED), (3, "Что имеем не храним потерявши плачем всегда")]
    items = spark.createDataFrame(rows, "item_id long, text string")
    docs = {
        1: ACCENTED.upper(), 2: unicodedata.normalize("NFD", ACCENTED), 3: ACCENTED.replace(" ", "\u00a0").replace("–", "—"),
        4: f"以前{UNSPACED[:15]}以后", 5: rows[2][1].upper(), 6: ACCENTED.replace("fallen", "fal\u00adlen"), 7: "Äpfel über die Straße",
    }
    got = leaks(documents(docs.items()), items)
    assert got == {1: {(1, 1.0)}, 2: {(1, 1.0)}, 3: {(1, 1.0)}, 4: {(2, 0.625)}, 5: {(3, 1.0)}, 6: {(1, 1.0)}, 7: set()}


def test_short_items_of_equal_text_leak_each(spark, documents):
    items = spark.createDataFrame([(1, "one two three"), (2, "One, two, three"), (3, "two")], "item_id long, text string")
    assert leaks(documents([(1, "so one two three go")]), items) == {1: {(1, 1.0), (2, 1.0), (3, 1.0)}}


def test_reordered_passages_are_whole_ones(documents, benchmark):
    a, b, c = ITEM.replace("!", ".").split(". ")
    docs = {
        1: f"before {ITEM} after", 2: f"{c} x {a.upper()} y, {b}; z", 3: f"only {a} here",
        4: "alpha gamma beta delta", 5: "he counts one, two - three", 6: "one two", 7: "p q r s t u " * 2, 8: f"{a} {a} {a}",
    }
    found = leaks(documents(docs.items()), benchmark)
    assert found == {
        1: {(1, 1.0)}, 2: {(1, 1.0)}, 3: {(1, round(6 / 18, 3))}, 4: set(), 5: {(2, 1.0)}, 6: set(), 7: {(5, 0.5)}, 8: {(1, round(6 / 18, 3))},
    }


def test_blocks_of_items_change_nothing(documents, benchmark, monkeypatch):
    docs = documents([(1, ITEM), (2, "one two three"), (3, "p q r s t u " * 9)])
    want = leaks(docs, benchmark)
    monkeypatch.setattr(decontaminate, "BLOCK_SEEDS", 5)
    monkeypatch.setattr(decontaminate, "AT_ONCE", 2)
    assert leaks(docs, benchmark) == want and want[3]


def test_decontamination_takes_odd_rows(spark, documents, odd_documents, benchmark):
    assert set().union(*leaks(odd_documents, benchmark).values()) == set()
    assert decontaminate.find_leaks(documents([]), benchmark).collect() == []
    assert leaks(documents([(1, ITEM)]), benchmark.limit(0)) == {1: set()}


def test_leak_query_finds_what_is_contained(spark):
    rows = queries.op9_benchmark_decontamination(spark, SF).collect()
    found = {(r.doc_id, r.item_id) for r in rows}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    contained = {(d, i) for d, text in docs.items() for i, item in items.items() if item in text}
    assert contained and contained <= found
    assert all(r.coverage >= decontaminate.COVERAGE for r in rows)
