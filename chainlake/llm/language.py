"""Language identification by error-correcting output codes.

Every language has a codeword; for each bit of the code a binary classifier over
character n-grams tells the languages with a one from those with a zero. A text goes
to the codeword with the least loss over its bits, each weighted by how well its
classifier did on the training texts. A small lead over the second is ambiguous.

The classifiers are log-odds from n-gram counts over all training texts, summed in
every task first: the driver gets one row of counts for each language and task group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import LOWER, slabs
from .common import arrow_rows, text_batches

BUCKET_BITS, SEED = 14, 3
#: Bits of the code for each doubling of the number of languages, and at least.
BITS_PER_DOUBLING, LEAST_BITS = 6, 15
#: A lead below this is ambiguous.
AMBIGUOUS = 0.05
UNKNOWN = "und"
#: Bytes of one n-gram.
GRAMS = (1, 2, 3)
SHARES = 8

LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True


def gram_buckets(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and bucket of every n-gram of lower-cased bytes.

    Bytes that are no letters, in ASCII, count as blanks.
    """
    low = LOWER[raw]
    low = np.where(LETTER[low] | (low >= 128), low, 32).astype(np.uint32)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    docs, buckets, code = [], [], np.zeros(len(low), np.uint32)
    for n in range(1, max(GRAMS) + 1):
        code = code[: len(low) - n + 1] * np.uint32(256) + low[n - 1 :]
        if n in GRAMS:
            inside = doc[: len(code)] == doc[n - 1 :]
            mixed = (code + np.uint32(n)) * np.uint32(0x9E3779B1)
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0x85EBCA77)
            docs.append(doc[: len(code)][inside])
            buckets.append((mixed >> np.uint32(32 - BUCKET_BITS))[inside].astype(np.int64))
    return np.concatenate(docs), np.concatenate(buckets)


def has_letters(texts: pa.Array) -> np.ndarray:
    return np.array([t is not None and any(map(str.isalpha, t)) for t in texts.to_pylist()], bool)


def codewords(languages: int) -> np.ndarray:
    """Distinct rows of +1 and -1, far apart; every bit parts the languages.

    The best of a number of random codes by its least distance between rows.
    """
    bits = max(LEAST_BITS, int(np.ceil(np.log2(max(2, languages)) * BITS_PER_DOUBLING)))
    if languages == 1:
        return np.ones((1, bits), np.int8)
    rng, best, far = np.random.default_rng(SEED), None, -1
    for _ in range(200):
        code = rng.integers(0, 2, (languages, bits), dtype=np.int8) * 2 - 1
        dull = np.abs(code.sum(axis=0)) == languages
        code[rng.integers(languages), dull] *= -1
        apart = (bits - code.astype(int) @ code.T) // 2
        least = apart[~np.eye(languages, dtype=bool)].min()
        if least > far:
            best, far = code, least
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # bucket by bit
    trust: np.ndarray  # by bit

    def margins(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Of each text and bit, in units of log-odds for each n-gram."""
        docs = len(offsets) - 1
        doc, bucket = gram_buckets(raw, offsets)
        order = np.argsort(doc, kind="stable")
        doc, bucket = doc[order], bucket[order]
        total = np.zeros((docs, self.code.shape[1]))
        counts = np.bincount(doc, minlength=docs)
        full = np.flatnonzero(counts)
        begins = (np.cumsum(counts) - counts)[full]
        if len(full):
            total[full] = np.add.reduceat(self.weights[bucket], begins, axis=0)
        return total / np.sqrt(np.maximum(counts, 1))[:, None]

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, score and lead over the next of each row of margins.

        The loss of a codeword is the weighted mean of ``log(1 + exp(-bit * margin))``.
        """
        loss = np.logaddexp(0, -margins[:, None, :] * self.code[None, :, :]) @ self.trust
        order = np.sort(loss, axis=1)
        likely = np.exp(-(loss - order[:, :1]) * self.code.shape[1])
        share = likely / likely.sum(axis=1, keepdims=True)
        best = loss.argmin(axis=1)
        score = share[np.arange(len(best)), best]
        lead = 2 * score - 1 if loss.shape[1] == 1 else score - np.sort(share, axis=1)[:, -2]
        return best, score, lead


def count_grams(rows: DataFrame) -> dict[str, np.ndarray]:
    """N-gram counts for each ``lang`` of ``rows``, over every text."""
    size = 1 << BUCKET_BITS

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch["lang"].to_pylist()
            for at, raw, offsets in slabs(batch["text"]):
                doc, bucket = gram_buckets(raw, offsets)
                own = names[at : at + len(offsets) - 1]
                kinds = {name: i for i, name in enumerate(dict.fromkeys(own))}
                kind = np.array([kinds[n] for n in own])
                counts = np.bincount(kind[doc] * size + bucket, minlength=len(kinds) * size).reshape(-1, size)
                for name, i in kinds.items():
                    total[name] = total.get(name, 0) + counts[i]
        if total:
            yield {"lang": list(total), "counts": [c.astype(np.int64).tobytes() for c in total.values()]}

    def add(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, total = None, np.zeros(size, np.int64)
        for batch in tables:
            for key, raw in zip(batch.column("lang").to_pylist(), batch.column("counts")):
                name = key
                total += np.frombuffer(raw.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([total.tobytes()], pa.binary())], ["lang", "counts"])

    parts = arrow_rows(rows, run, "lang string, counts binary").withColumn("share", F.spark_partition_id() % SHARES)
    sums = parts.groupBy("lang", "share").applyInArrow(add, "lang string, counts binary").collect()
    out: dict[str, np.ndarray] = {}
    for r in sums:
        out[r["lang"]] = out.get(r["lang"], 0) + np.frombuffer(r["counts"], np.int64)
    return out


def train(docs: DataFrame, trains) -> LanguageModel | None:
    """Learn from ``text`` and non-null ``lang`` where ``trains`` holds; ``None`` without any."""
    text_batches(docs.sparkSession)
    rows = docs.where(trains).where("text is not null and lang is not null").select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = count_grams(rows)
    names = sorted(counts)
    if not names:
        return None
    code = codewords(len(names))
    share = np.stack([(c + 0.5) / (c + 0.5).sum() for c in (counts[n] for n in names)])
    weights = np.zeros((share.shape[1], code.shape[1]), np.float32)
    for bit in range(code.shape[1]):
        ones = code[:, bit] > 0
        if ones.all() or not ones.any():
            continue
        weights[:, bit] = np.log(share[ones].mean(axis=0)) - np.log(share[~ones].mean(axis=0))
    # how far a bit's classifier parts the languages it has to part
    drift = np.abs(share @ weights)
    trust = drift.min(axis=0) + 1e-6
    return LanguageModel(names, code, weights, trust / trust.sum())


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous`` for every row of ``docs``.

    Texts that are null or without a letter are ``und`` with score 0; so are all if
    nothing was learnt. Only ``text`` decides.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    text_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        known = sent.value
        for batch in batches:
            for at, raw, offsets in slabs(batch["text"]):
                n = len(offsets) - 1
                text = batch["text"].slice(at, n)
                name, score, lead = np.full(n, UNKNOWN, object), np.zeros(n), np.zeros(n)
                told = has_letters(text) if known else np.zeros(n, bool)
                if told.any():
                    best, found, ahead = known.decode(known.margins(raw, offsets))
                    name[told] = np.array(known.languages, object)[best[told]]
                    score[told], lead[told] = found[told], ahead[told]
                yield {"doc_id": batch["doc_id"].slice(at, n), "lang_pred": name.tolist(), "score": score, "ambiguous": lead < AMBIGUOUS}

    return arrow_rows(texts, run, "doc_id long, lang_pred string, score double, ambiguous boolean")
