"""Quality scores: a Gaussian kernel over document statistics, approximated.

Random Fourier features stand for the kernel, ridge regression on them is fitted by
normal equations that every task sums over its own rows, and isotonic regression
turns scores into probabilities. All labelled rows are used; what reaches the driver
has the size of the features, not of the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import BYTE_VALUES, NOT_SPACE, Rolling, doc_sums, slabs, word_bounds, word_hashes
from .common import arrow_rows, document_texts, settle

FEATURES, RIDGE, SEED = 384, 1e-3, 5
#: Scores are calibrated on this many bins between -0.5 and 1.5.
BINS = 2000
#: Sums are added up in so many groups before they reach the driver.
GROUPS = 8

STATISTICS = (
    "log_bytes log_words word_length word_spread letters upper digits spaces wide stops "
    "commas shouts questions symbols bars quotes brackets other capitals "
    "distinct log_longest lines_distinct log_line_words symbol_words digit_words"
).split()

#: Classes of bytes, by name.
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digits": b"0123456789",
    "spaces": b" \t\n\r\x0b\x0c", "stops": b".", "commas": b",;:", "shouts": b"!", "questions": b"?",
    "symbols": b"#$%&*@^~=+_\\/", "bars": b"|", "quotes": b"'\"`", "brackets": b"()[]{}<>", "wide": bytes(range(128, 256)),
}
CLASS_OF = np.full(256, len(CLASSES))
for _i, _bytes in enumerate(CLASSES.values()):
    CLASS_OF[list(_bytes)] = _i
IN_CLASS = {name: CLASS_OF == i for i, name in enumerate(CLASSES)}


def statistics(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of ``STATISTICS`` for each text; all zero ratios for an empty one."""
    docs, size = len(offsets) - 1, np.diff(offsets)
    doc_of = np.repeat(np.arange(docs), size)
    counts = np.bincount(doc_of * (len(CLASSES) + 1) + CLASS_OF[raw], minlength=docs * (len(CLASSES) + 1))
    share = counts.reshape(docs, -1) / np.maximum(size, 1)[:, None]
    of = {name: share[:, i] for i, name in enumerate(CLASSES)}
    hashes, doc, starts, stops = word_hashes(raw, offsets, NOT_SPACE)
    length, words = stops - starts, np.bincount(doc, minlength=docs)
    per_word = np.maximum(words, 1)
    mean = doc_sums(length, doc, docs) / per_word
    spread = np.sqrt(np.maximum(0, doc_sums(length * length, doc, docs) / per_word - mean**2))
    longest = np.zeros(docs)
    np.maximum.at(longest, doc, length)
    line_starts, line_stops = word_bounds(raw, offsets, np.arange(256) != 10)
    line_doc = np.searchsorted(offsets, line_starts, "right") - 1
    line_hashes = Rolling(BYTE_VALUES[raw]).runs(line_starts, line_stops)
    lines = np.bincount(line_doc, minlength=docs)
    last = raw[stops - 1] if len(stops) else raw[:0]
    odd = IN_CLASS["symbols"] | IN_CLASS["bars"] | IN_CLASS["shouts"]
    known = {
        "log_bytes": np.log1p(size), "log_words": np.log1p(words), "word_length": mean, "word_spread": spread,
        "letters": of["upper"] + of["lower"] + of["wide"], "other": share[:, -1],
        "capitals": doc_sums(IN_CLASS["upper"][raw[starts]], doc, docs) / per_word,
        "distinct": distinct(hashes, doc, docs) / per_word, "log_longest": np.log1p(longest),
        "lines_distinct": distinct(line_hashes, line_doc, docs) / np.maximum(lines, 1),
        "log_line_words": np.log1p(words / np.maximum(lines, 1)),
        "symbol_words": doc_sums(odd[last], doc, docs) / per_word,
        "digit_words": doc_sums(IN_CLASS["digits"][last], doc, docs) / per_word,
    }
    return np.column_stack([known[name] if name in known else of[name] for name in STATISTICS])


def distinct(hashes: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Distinct hashes of each document."""
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return np.bincount(d[new], minlength=docs)


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, x``: the statistics of every whole text; null counts as empty."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            for at, raw, offsets in slabs(batch["text"]):
                x = statistics(raw, offsets).astype(np.float32)
                yield {"doc_id": batch["doc_id"].slice(at, len(x)), "x": list(x)}

    return arrow_rows(document_texts(docs), run, "doc_id long, x array<float>")


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    steps: np.ndarray  # calibrated probability at the middle of each bin

    def features(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features, the standardised statistics and a constant."""
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        rng = np.random.default_rng(SEED)
        directions = rng.normal(size=(len(STATISTICS), FEATURES)) / np.sqrt(len(STATISTICS))
        phases = rng.uniform(0, 2 * np.pi, FEATURES)
        waves = np.cos(z @ directions + phases) * np.sqrt(2 / FEATURES)
        return np.column_stack([waves, z / 10, np.ones(len(z))])

    def score(self, x: np.ndarray) -> np.ndarray:
        place = (self.features(x) @ self.weights + 0.5) * BINS / 2 - 0.5
        return np.clip(np.interp(place, np.arange(BINS), self.steps), 0, 1)


def column_matrix(column) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, len(STATISTICS)).astype(float)


def fit(rows: DataFrame) -> QualityModel:
    """Fit on ``x, y`` rows (stored); without rows every score is 0.5."""
    width = FEATURES + len(STATISTICS) + 1
    model = QualityModel(np.zeros(len(STATISTICS)), np.ones(len(STATISTICS)), np.zeros(width), np.full(BINS, 0.5))

    def moments(batches):
        total = np.zeros((3, len(STATISTICS)))
        for batch in batches:
            x = column_matrix(batch["x"])
            total += np.stack([np.full(x.shape[1], len(x)), x.sum(axis=0), (x * x).sum(axis=0)])
        yield {"sums": [total.tobytes()]}

    total = summed(arrow_rows(rows, moments, "sums binary"), (3, len(STATISTICS)))
    n = total[0, 0]
    if not n:
        return model
    model.mean = total[1] / n
    model.scale = np.sqrt(np.maximum(total[2] / n - model.mean**2, 0)) + 1e-6

    def normal_equations(batches):
        total = np.zeros((width, width + 1))
        for batch in batches:
            y = batch["y"].to_numpy().astype(float)
            for at in range(0, len(y), 2048):
                z = model.features(column_matrix(batch["x"].slice(at, 2048)))
                total += z.T @ np.column_stack([z, y[at : at + 2048]])
        yield {"sums": [total.tobytes()]}

    equations = summed(arrow_rows(rows, normal_equations, "sums binary"), (width, width + 1))
    model.weights = np.linalg.solve(equations[:, :-1] + RIDGE * n / 100 * np.eye(width), equations[:, -1])

    def binned(batches):
        total = np.zeros((2, BINS))
        for batch in batches:
            y = batch["y"].to_numpy().astype(float)
            place = np.clip((model.features(column_matrix(batch["x"])) @ model.weights + 0.5) * BINS / 2, 0, BINS - 1).astype(int)
            total += np.stack([np.bincount(place, minlength=BINS), np.bincount(place, weights=y, minlength=BINS)])
        yield {"sums": [total.tobytes()]}

    model.steps = isotonic(*summed(arrow_rows(rows, binned, "sums binary"), (2, BINS)))
    return model


def summed(parts: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """The sum of the tasks' arrays, added up by ``GROUPS`` tasks first."""

    def add(batches):
        total = np.zeros(shape)
        for batch in batches:
            for raw in batch.column("sums"):
                total += np.frombuffer(raw.as_buffer(), float).reshape(shape)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    rows = parts.repartition(GROUPS).mapInArrow(add, "sums binary").collect()
    return sum((np.frombuffer(r["sums"], float).reshape(shape) for r in rows), np.zeros(shape))


def isotonic(counts: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """The rising step function nearest to the rates of the bins, at every bin."""
    used = np.flatnonzero(counts)
    blocks: list[list[float]] = []  # rows, hits, bins
    for i in used:
        blocks.append([counts[i], hits[i], 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            rows, found, bins = blocks.pop()
            blocks[-1] = [blocks[-1][0] + rows, blocks[-1][1] + found, blocks[-1][2] + bins]
    rates = np.concatenate([np.full(int(b), h / n) for n, h, b in blocks])
    return np.interp(np.arange(len(counts)), used, rates)


def score_quality(docs: DataFrame, labels: DataFrame, trains) -> DataFrame:
    """``doc_id, score`` for every row of ``docs``, null and empty texts too.

    Labels are learnt from rows of ``labels`` (``doc_id, quality``) where the column
    ``trains`` holds; null labels and ids aren't used. A document labelled twice
    counts twice. Scores see the text alone. Without labels all scores are 0.5.
    """
    stored = settle(document_statistics(docs), "statistics")
    known = labels.where(trains).where("doc_id is not null and quality is not null")
    rows = settle(stored.join(known.select(F.col("doc_id").cast("long"), F.col("quality").cast("double").alias("y")), "doc_id").select("x", "y"), "labelled")
    model = fit(rows)

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch["doc_id"]), 2048):
                x = column_matrix(batch["x"].slice(at, 2048))
                yield {"doc_id": batch["doc_id"].slice(at, 2048), "score": model.score(x)}

    return arrow_rows(stored, run, "doc_id long, score double")
