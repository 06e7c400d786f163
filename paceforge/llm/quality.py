"""Quality of texts: ridge regression on random Fourier features of text statistics, then isotonic calibration.

A text becomes a few statistics (lengths, letters, marks, repetition). Cosines of random directions of the scaled statistics stand in for a
Gaussian kernel. Each partition of the training rows sums its own normal equations, Spark adds
them up by cell, and the driver solves one system of bounded size. On rows kept out of that, an isotonic curve
turns values into the share of good texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceforge.llm.common import chunks, stored, strings

#: Cosines, width of the kernel in scaled statistics, and ridge (a share of the rows).
COSINES, WIDTH, RIDGE = 192, 3.0, 1e-4
#: Labelled rows drawn for the equations, and for the curve.
FIT_ROWS, CURVE_ROWS = 60_000, 30_000
#: Partitions that sum equations of their own.
PARTS = 8
SEED = 20

UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGITS = bytes(range(48, 58))
SYMBOLS = b"#$%&*+/<=>@[\\]^_`{|}~"
STOPS = b".!?"
STATISTICS = (
    "log_bytes log_words word_length distinct_words top_word equal_neighbours distinct_pairs upper digits symbols stops commas exclamations bars other "
    "marked_ends upper_words one_letter lines repeated_lines long_words"
).split()


def _count(raw: bytes, these: bytes) -> int:
    return len(raw) - len(raw.translate(None, these))


def statistics(text: str) -> list[float]:
    """Statistics of a whole text; all zero for an empty one."""
    raw = text.encode()
    words = text.split()
    if not words:
        return [float(np.log1p(len(raw)))] + [0.0] * (len(STATISTICS) - 1)
    n, size = len(words), len(raw)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x]
    upper, lower = _count(raw, UPPER), _count(raw, LOWER)
    return [
        float(np.log1p(size)),
        float(np.log1p(n)),
        sum(map(len, words)) / n,
        len(counts) / n**0.75,
        max(counts.values()) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        len(set(zip(words, words[1:]))) / max(1, n - 1),
        upper / max(1, upper + lower),
        _count(raw, DIGITS) / size,
        _count(raw, SYMBOLS) / size,
        _count(raw, STOPS) / n,
        raw.count(b",") / n,
        raw.count(b"!") / n,
        raw.count(b"|") / n,
        _count(raw, bytes(range(128, 256))) / size,
        sum(not w[-1].isalnum() for w in words) / n,
        sum(map(str.isupper, words)) / n,
        sum(len(w) == 1 for w in words) / n,
        float(np.log1p(n / max(1, len(lines)))),
        1 - len(set(lines)) / max(1, len(lines)),
        sum(len(w) > 20 for w in words) / n,
    ]


def described(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, stats) of every row; a null text counts as empty."""
    kind = dict(docs.select(doc_id).dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches):
            rows = [statistics(t) for t in strings(piece.column(1))]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "stats"])

    return docs.select(doc_id, text).mapInArrow(run, f"doc_id {kind}, stats array<double>")


@dataclass
class Model:
    """Scaling, directions, weights and curve; without weights every row gets ``prior``."""

    prior: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    knots: np.ndarray | None = None
    levels: np.ndarray | None = None

    def features(self, stats: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(SEED)
        directions = rng.normal(0, 1 / WIDTH, (len(STATISTICS), COSINES))
        phases = rng.uniform(0, 2 * np.pi, COSINES)
        scaled = np.clip((stats - self.mean) / self.scale, -8, 8)
        return np.hstack([np.cos(scaled @ directions + phases) * np.sqrt(2 / COSINES), np.ones((len(stats), 1))])

    def values(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def scores(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None or not len(stats):
            return np.full(len(stats), self.prior)
        return np.interp(self.values(stats), self.knots, self.levels)


def isotonic(values: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means of the values and of the marks in the blocks that pooling of adjacent violators leaves."""
    order = np.argsort(values, kind="stable")
    blocks: list[list[float]] = []  # sum of values, sum of marks, rows
    for v, m in zip(values[order].tolist(), marks[order].tolist()):
        blocks.append([v, m, 1.0])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def _matrix(batch: pa.RecordBatch, column: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(STATISTICS))


def _equations(model: Model, rows: DataFrame) -> np.ndarray:
    """Normal equations of all rows (stats, mark) with the marks' moments as last column, summed by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((COSINES + 1, COSINES + 2))
        for piece in chunks(batches):
            if piece.num_rows:
                x = model.features(_matrix(piece, 0))
                y = piece.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
                total += x.T @ np.hstack([x, y[:, None]])
        cells = np.arange(total.size, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.ravel())], ["cell", "value"])

    summed = rows.repartition(PARTS).mapInArrow(run, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros((COSINES + 1) * (COSINES + 2))
    out[summed.column(0).to_numpy()] = summed.column(1).to_numpy()
    return out.reshape(COSINES + 1, COSINES + 2)


def learn(stats: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id") -> Model:
    """A model from rows (doc_id, stats) with a label of 0 or 1; one in three, by a hash of the id, is kept for the curve.

    About ``FIT_ROWS`` and ``CURVE_ROWS`` rows are drawn by that hash; the driver gets sums, and values and marks of the latter.
    """
    marks = labels.where(F.col(label).isin(0, 1)).groupBy(doc_id).agg(F.max(label).cast("double").alias("mark"))
    draw = F.pmod(F.xxhash64(F.col(doc_id), F.lit(5)), F.lit(3_000_000))
    rows = stats.join(marks, doc_id).select("stats", "mark", draw.alias("draw"))
    n = rows.count()
    part = 1_000_000
    curve = stored(rows.where(F.col("draw") < part * min(1.0, CURVE_ROWS / max(1, n / 3))).select("stats", "mark"))
    fit = stored(rows.where((F.col("draw") >= part) & (F.col("draw") < part + 2 * part * min(1.0, FIT_ROWS / max(1, 2 * n / 3)))).select("stats", "mark"))
    moments = fit.agg(F.count("*").alias("n"), F.avg("mark").alias("prior"), *(f(F.col("stats")[k]).alias(f"{f.__name__}_{k}") for k in range(len(STATISTICS)) for f in (F.avg, F.stddev_pop))).first()
    held = curve.toArrow().combine_chunks()
    if not moments.n or moments.prior in (0.0, 1.0) or not held.num_rows:
        return Model(0.5 if moments.prior is None else moments.prior)
    model = Model(moments.prior)
    model.mean = np.array([moments[f"avg_{k}"] for k in range(len(STATISTICS))])
    model.scale = np.maximum(1e-6, [moments[f"stddev_pop_{k}"] for k in range(len(STATISTICS))])
    sums = _equations(model, fit)
    model.weights = np.linalg.solve(sums[:, :-1] + RIDGE * moments.n * np.eye(COSINES + 1), sums[:, -1])
    batch = held.to_batches()[0]
    model.knots, model.levels = isotonic(model.values(_matrix(batch, 0)), held.column(1).to_numpy())
    return model


def score(stats: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of rows (doc_id, stats)."""
    held = stats.sparkSession.sparkContext.broadcast(model)
    kind = dict(stats.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches):
            found = held.value.scores(_matrix(piece, 1))
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    return stats.select("doc_id", "stats").mapInArrow(run, f"doc_id {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row of ``docs``, learned from ``labels`` (doc_id, quality). Null and empty texts are scored
    as empty; without labels of both kinds every score is their share, or one half. Repeated rows are all returned."""
    stats = stored(described(docs, doc_id, text))
    return score(stats, learn(stats, labels))
