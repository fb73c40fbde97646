"""Quality scores: a regularised quadratic discriminant over transformed document statistics.

Class means and covariances come from sums over all labelled rows that may be learned from
(count, sum, sum of squares and products, folded per task), so nothing is sampled for them.  The
covariances are shrunk towards their pooled form and its diagonal.  A text's score is the
difference of its two log densities, from Mahalanobis distances by the cached Cholesky factors,
put on a scale of 0 to 1 by a logistic curve.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from protolith.session import cut_lineage

from .rules import SYMBOLS, WHITE, repeated_words
from .textkit import blocks, may_learn

FEATURES = ("words", "word_length", "long_words", "upper", "digits", "symbols", "stops", "marks", "blanks", "wide",
            "distinct", "doubled", "repeated", "ratio", "lines", "dup_lines", "marked_words")
#: Shrinkage towards the pooled covariance and towards its diagonal.
TO_POOLED, TO_DIAGONAL = 0.1, 0.05
#: Most labelled rows whose densities set the logistic curve.
CURVE_ROWS = 20_000
THRESHOLD = 0.7


def statistics(text: bytes, press: zstandard.ZstdCompressor) -> list[float]:
    """Transformed statistics of a whole text, every one finite, also for an empty text."""
    words = text.split()
    n, size = len(words), len(text)
    if not n:
        return [0.0] * len(FEATURES)

    def share(characters: bytes) -> float:
        return (size - len(text.translate(None, characters))) / size

    lengths = [len(w) for w in words]
    distinct = len(set(words))
    doubled = sum(map(bytes.__eq__, words, words[1:]))
    lines = [x for x in text.split(b"\n") if x.strip()]
    marked = sum(not w[-1:].isalnum() and w[-1] < 128 and w[-2:-1] in b"!#*$%&|<>?" for w in words if len(w) > 1)
    marked += sum(w in (b"|", b"&", b"*", b"#") for w in words)
    return [
        np.log1p(n), np.log(sum(lengths) / n), np.sqrt(sum(x > 20 for x in lengths) / n),
        np.sqrt(share(bytes(range(65, 91)))), np.sqrt(share(b"0123456789")), np.sqrt(share(SYMBOLS)), np.sqrt(share(b".,;:")),
        np.sqrt(share(b"!?")), share(WHITE), np.sqrt(share(bytes(range(128, 256)))),
        np.log(distinct) / np.log(n) if n > 1 else 1.0, np.sqrt(doubled / n), np.sqrt(repeated_words(words) / n),
        np.log(size / len(press.compress(text))), np.log1p(len(lines)), np.sqrt(1 - len(set(lines)) / max(len(lines), 1)),
        np.sqrt(marked / n),
    ]


def describe(docs: DataFrame) -> DataFrame:
    """``doc_id, x`` (the statistics) for every row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for block in blocks(batch.column(1)):
                rows = [statistics(block.text(i), press) for i in range(len(block.start) - 1)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[block.rows], pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, x array<double>")


class Discriminant(NamedTuple):
    mean: np.ndarray      # by class
    factor: np.ndarray    # inverse Cholesky factors by class
    offset: np.ndarray    # log prior less half the log determinant by class
    curve: tuple[float, float]

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0."""
        out = []
        for k in (0, 1):
            z = (x - self.mean[k]) @ self.factor[k].T
            out.append(self.offset[k] - 0.5 * (z * z).sum(axis=1))
        return out[1] - out[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        slope, shift = self.curve
        return 1 / (1 + np.exp(-np.clip(slope * self.difference(x) + shift, -35, 35)))


def moments(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sum and sum of products of ``x`` by ``label``; a row per task and label reaches the driver's sum."""
    d = len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(-1, d)
            label = batch.column(1).to_numpy()
            for k in (0, 1):
                part = x[label == k]
                total[k] += np.concatenate([[len(part)], part.sum(axis=0), (part.T @ part).ravel()])
        at = np.tile(np.arange(total.shape[1]), 2)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat([0, 1], total.shape[1])), pa.array(at), pa.array(total.ravel())], ["label", "at", "value"])

    sums = rows.select("x", "label").mapInArrow(run, "label long, at long, value double").groupBy("label", "at").agg(F.sum("value").alias("value"))
    out = np.zeros((2, 1 + d + d * d))
    for row in sums.collect():
        out[row.label, row.at] = row.value
    return {k: (out[k, 0], out[k, 1:1 + d], out[k, 1 + d:].reshape(d, d)) for k in (0, 1)}


def fit(stats: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> Discriminant | None:
    """Shrunken class covariances and their factors; None when a class has fewer than two rows."""
    if any(stats[k][0] < 2 for k in (0, 1)):
        return None
    mean = np.array([stats[k][1] / stats[k][0] for k in (0, 1)])
    spread = [stats[k][2] - stats[k][0] * np.outer(mean[k], mean[k]) for k in (0, 1)]
    pooled = (spread[0] + spread[1]) / (stats[0][0] + stats[1][0] - 2)
    factor, offset = [], []
    for k in (0, 1):
        s = (1 - TO_POOLED) * spread[k] / (stats[k][0] - 1) + TO_POOLED * pooled
        s = (1 - TO_DIAGONAL) * s + TO_DIAGONAL * np.diag(np.diag(pooled))
        s += np.eye(len(s)) * 1e-4
        low = np.linalg.cholesky(s)
        factor.append(np.linalg.inv(low))
        offset.append(np.log(stats[k][0] / (stats[0][0] + stats[1][0])) - np.log(np.diag(low)).sum())
    return Discriminant(mean, np.array(factor), np.array(offset), (1.0, 0.0))


def logistic_curve(value: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the most likely logistic curve, held back a little from certainty."""
    target = np.where(label == 1, 1 - 1 / (label.sum() + 2), 1 / ((1 - label).sum() + 2))
    scale = max(float(np.abs(value).mean()), 1e-9)
    v = np.clip(value / scale, -20, 20)
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * v + shift, -35, 35)))
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - target) * v).sum() + 1e-3 * slope, (p - target).sum()])
        h = np.array([[(w * v * v).sum() + 1e-3, (w * v).sum()], [(w * v).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 1.0 / max(np.abs(step).max(), 1e-9))
        slope, shift = slope - step[0], shift - step[1]
    return max(slope, 1e-6) / scale, shift


def learn(described: DataFrame, labels: DataFrame, label: str) -> Discriminant | None:
    """Fit to all labelled rows that may be learned from; an id with several labels takes the smallest."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter(may_learn("doc_id") & F.col("label").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    rows = described.select("doc_id", "x").join(known, "doc_id")
    model = fit(moments(rows))
    if model is None:
        return None
    few = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(CURVE_ROWS).select("x", "label").toPandas()
    x = np.array(few["x"].tolist())
    return model._replace(curve=logistic_curve(model.difference(x), few["label"].to_numpy()))


def score(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """``doc_id, score, predicted`` for every whole text; a higher score makes label 1 likelier.

    NULL and empty texts are described by zeros and scored like others; without two rows of either
    class to learn from, every score is 0.5.  Repeated rows and missing ids give rows like any others.
    """
    described = cut_lineage(describe(docs))
    shared = docs.sparkSession.sparkContext.broadcast(learn(described, labels, label))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(FEATURES))
            value = shared.value.score(x) if shared.value is not None else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value), pa.array((value >= THRESHOLD).astype(np.int32))],
                                             ["doc_id", "score", "predicted"])

    return described.mapInArrow(run, "doc_id long, score double, predicted int")
