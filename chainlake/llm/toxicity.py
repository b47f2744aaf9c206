"""Toxicity scores that don't move when one group is named instead of another.

A logistic model over the words that a text holds and how they begin, hashed to a
fixed number of weights. Identity terms in labelled sentences are swapped for others of
their kind; the loss adds the squared change of the score for each swap, so a
group's name can't carry blame that belongs to the words around it. An L1 penalty
leaves weight only on what marks toxic texts, so long clean texts don't add up noise.

The model is fitted on a sample of at most ``SAMPLE`` labelled rows of either class,
whatever the size of the tables; every text is scored whole.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import BYTE_VALUES, LOWER, WORD_BYTES, Rolling, slabs, word_bounds
from .common import arrow_rows, document_texts, forget, text_of, whole_row

#: Labelled rows of either class that the model is fitted on at most, about.
SAMPLE = 4_000
#: Sentences with a swapped identity term at most, about; with all, it is the same sample.
SWAPS = 20_000
BUCKET_BITS = 20
#: Bytes of the beginnings of longer words.
STEMS = (4, 5, 6)
L1, SWAP_WEIGHT, ROUNDS = 1e-3, 1.0, 300
#: Buckets that fewer sampled texts hold get no weight.
LEAST_TEXTS = 3

#: Identity terms by kind, in the languages of the tables.
IDENTITY_TERMS = [
    "women men girls boys women's men's female male",
    "femmes hommes filles garçons mujeres hombres chicas chicos frauen männer mädchen jungen",
    "muslims christians jews hindus buddhists atheists catholics protestants",
    "muslim christian jewish hindu buddhist atheist catholic protestant",
    "black white asian latino african european arab indigenous",
    "gay straight lesbian bisexual queer transgender trans heterosexual",
    "immigrants refugees foreigners natives locals migrants",
    "americans mexicans chinese indians russians germans french africans turks poles",
    "old young elderly disabled deaf blind",
]


def held(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and bucket of every distinct word and beginning of a word."""
    low = LOWER[raw]
    starts, stops = word_bounds(low, offsets, WORD_BYTES)
    doc = np.searchsorted(offsets, starts, "right") - 1
    rolling = Rolling(BYTE_VALUES[low])
    hashes, docs = [rolling.runs(starts, stops)], [doc]
    for n in STEMS:
        longer = stops - starts > n
        hashes.append(rolling.runs(starts[longer], starts[longer] + n))
        docs.append(doc[longer])
    doc, bucket = np.concatenate(docs), np.concatenate(hashes) >> np.uint64(64 - BUCKET_BITS)
    keys = np.unique((doc.astype(np.uint64) << np.uint64(BUCKET_BITS)) | bucket)
    return (keys >> np.uint64(BUCKET_BITS)).astype(np.int64), (keys & np.uint64((1 << BUCKET_BITS) - 1)).astype(np.int64)


def buckets_of(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return held(raw, np.array([0, len(raw)]))[1]


def swaps(text: str) -> list[tuple[list[int], list[int]]]:
    """For each sentence with an identity term: buckets that a swap takes and adds."""
    found = []
    kinds = [kind.split() for kind in IDENTITY_TERMS]
    for sentence in text.replace("!", ".").replace("?", ".").replace("\n", ".").split("."):
        words = sentence.lower().split()
        for i, word in enumerate(words):
            for kind in kinds:
                if word in kind:
                    other = kind[(kind.index(word) + 1 + len(words) % (len(kind) - 1)) % len(kind)]
                    swapped = " ".join([*words[:i], other, *words[i + 1 :]])
                    a, b = buckets_of(" ".join(words)), buckets_of(swapped)
                    found.append((np.setdiff1d(a, b).tolist(), np.setdiff1d(b, a).tolist()))
    return found


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float

    def score(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        doc, bucket = held(raw, offsets)
        z = self.bias + np.bincount(doc, weights=self.weights[bucket], minlength=len(offsets) - 1)
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(texts: list[np.ndarray], y: np.ndarray, changes: list[tuple[list[int], list[int]]]) -> ToxicityModel:
    """Accelerated proximal descent; ``texts`` are buckets, ``changes`` swapped ones."""
    size = 1 << BUCKET_BITS
    if not len(y) or y.min() == y.max():
        rate = float(y.mean()) if len(y) else 0.5
        return ToxicityModel(np.zeros(size), float(np.log((rate + 0.01) / (1.01 - rate))))
    lengths = np.array([len(t) for t in texts])
    columns = np.concatenate(texts)
    common = np.bincount(columns, minlength=size) >= LEAST_TEXTS
    row = np.repeat(np.arange(len(texts)), lengths)[common[columns]]
    names, columns = np.unique(columns[common[columns]], return_inverse=True)
    place = {int(b): i for i, b in enumerate(names)} if changes else {}
    ends = [(i, sign, place[b]) for i, pair in enumerate(changes) for sign, side in zip((-1, 1), pair) for b in side if b in place]
    swap, sign, column = (np.array(x, np.int64) for x in zip(*ends)) if ends else (np.zeros(0, np.int64),) * 3
    share = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))

    def gradient(w, b):
        z = np.bincount(row, weights=w[columns], minlength=len(y)) + b
        slope = share * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y)
        g = np.bincount(columns, weights=slope[row], minlength=len(names))
        if len(swap):
            change = np.bincount(swap, weights=sign * w[column], minlength=len(changes))
            g += SWAP_WEIGHT / len(changes) * np.bincount(column, weights=sign * change[swap], minlength=len(names))
        return g, slope.sum(), z

    # the curvature along a vector that holds all buckets alike bounds the step well enough
    reach = np.sqrt(np.bincount(row, minlength=len(y)).mean() + 1)
    step, w, b = 4.0 / reach, np.zeros(len(names)), 0.0
    ahead, ahead_b, t, last = w, b, 1.0, np.inf
    for _ in range(ROUNDS):
        g, gb, z = gradient(ahead, ahead_b)
        loss = float(share @ (np.logaddexp(0, z) - y * z)) + L1 * np.abs(ahead).sum()
        if loss > last * 1.02 + 1e-9:
            step, ahead, ahead_b, t, last = step / 2, w, b, 1.0, np.inf
            continue
        last = loss
        new = ahead - step * g
        new = np.sign(new) * np.maximum(np.abs(new) - step * L1, 0)
        new_b, following = ahead_b - step * gb, (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / following * (new - w)
        ahead_b = new_b + (t - 1) / following * (new_b - b)
        w, b, t = new, new_b, following
    full = np.zeros(size)
    full[names] = w
    return ToxicityModel(full, b)


def sample(docs: DataFrame, labels: DataFrame, trains) -> list[tuple[np.ndarray, int, list]]:
    """Buckets, label and swaps of about ``SAMPLE`` labelled texts of either class at most.

    Which ones, a hash of the ``doc_id`` decides, the same at every run.
    """
    known = labels.where(trains).where("doc_id is not null and toxic is not null").select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") > 0).cast("double").alias("y"))
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    shares = [int(min(1.0, SAMPLE / totals.get(y, 1)) * 1_000_000) for y in (0.0, 1.0)]
    part = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000)) < F.when(F.col("y") > 0, shares[1]).otherwise(shares[0])
    # At most about twice SAMPLE rows of two numbers, so the texts stay where they are.
    rows = document_texts(docs).join(F.broadcast(known.where(part)), "doc_id")

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            for at, raw, offsets in slabs(batch["text"]):
                doc, bucket = held(raw, offsets)
                parts = np.split(bucket.astype(np.int32), np.searchsorted(doc, np.arange(1, len(offsets) - 1)))
                texts = batch["text"].slice(at, len(parts)).to_pylist()
                yield {
                    "buckets": [p.tobytes() for p in parts],
                    "y": batch["y"].slice(at, len(parts)),
                    "swaps": [json.dumps(swaps(t or "")) for t in texts],
                }

    found = arrow_rows(rows, run, "buckets binary, y double, swaps string").collect()
    return [(np.frombuffer(r["buckets"], np.int32), r["y"], json.loads(r["swaps"])) for r in found]


def train(docs: DataFrame, labels: DataFrame, trains) -> ToxicityModel:
    """Fit on the labelled rows where the column ``trains`` holds."""
    rows = sample(docs, labels, trains)
    changes = [pair for _, _, pairs in rows for pair in pairs][:SWAPS]
    return fit([r[0] for r in rows], np.array([r[1] for r in rows]), changes)


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Every ``row`` of ``docs`` with a ``score`` from 0 to 1; null counts as empty.

    An empty text has the score of a text without any telling word.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))
    return docs.select(whole_row(docs)).withColumn("score", F.arrow_udf(scorer(sent), "double")(text_of()))


def scorer(sent):
    def score(texts: pa.Array) -> pa.Array:
        forget()
        weights, bias = sent.value
        model = ToxicityModel(weights, bias)
        parts = [model.score(raw, offsets) for _, raw, offsets in slabs(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return score
