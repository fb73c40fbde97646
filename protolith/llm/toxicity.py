"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features: densities of lexicon words as written and with disguises undone, second-person words
near them, capitals, punctuation, and disguise rates.  The lexicon is a short fixed list and the
words that tell toxic from other texts in a bounded sample of labelled rows.  The words come from
two fifths of that sample, the trees from four fifths of the rest, the calibration from what is
left, so that none of them is judged on rows it was learned from.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from protolith.session import cut_lineage

from .textkit import blocks, sample_ids

#: Most labelled rows that the lexicon, the trees and the calibration are learned from.
SAMPLE_ROWS = 20_000
TREES, DEPTH, RATE, BINS, LEAST_LEAF = 60, 3, 0.2, 32, 10
THRESHOLD = 0.3
NEAR = 6
# common insults (fixed values)
INSULTS = ("idiot", "idiots", "moron", "stupid", "dumb", "loser", "losers", "scum", "trash", "garbage", "pathetic", "worthless",
           "disgusting", "clown", "fool", "imbecile", "filth", "vermin", "ugly", "hate", "idiota", "imbécil", "estúpido", "basura",
           "dumm", "blöd", "abschaum", "versager", "crétin", "imbécile", "stupide", "ordure")
# second-person words of the same languages (fixed values)
SECOND_PERSON = ("you", "your", "yours", "youre", "u", "ur", "yourself", "du", "dich", "dir", "dein", "deine", "ihr", "euch",
                 "tu", "te", "toi", "ton", "ta", "vous", "votre", "tú", "ti", "tus", "usted", "ustedes", "vosotros")
FEATURES = ("words", "lexicon", "lexicon_count", "learned", "learned_count", "undone", "person", "near", "upper_words", "upper",
            "marks", "punctuation", "mixed_words", "spaced", "stretched")

_CLEAN = bytes(b + 32 if 65 <= b <= 90 else b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256))
_KEEP = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_UNDO = bytes.maketrans(b"013457@$!", b"oieastasi")
_EDGE = b".,;:!?\"'()[]{}<>"


#: Lengths in bytes of the word beginnings that may stand in the learned lexicon beside whole words.
STEMS = (5, 7)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_CLEAN).split()


def stems(word: bytes) -> list[bytes]:
    return [word[:n] + b"*" for n in STEMS if len(word) > n]


def features(text: bytes, fixed: frozenset, learned: frozenset, person: frozenset) -> list[float]:
    """Dense features of a whole text; all zero for a text without words."""
    words = words_of(text)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    hits = [i for i, w in enumerate(words) if w in fixed]
    typical = {w for w in set(words) if w in learned or any(x in learned for x in stems(w))}
    more = [i for i, w in enumerate(words) if w in typical]
    you = [i for i, w in enumerate(words) if w in person]
    at = np.array(sorted({*hits, *more}))
    near = 0
    if len(at) and you:
        gap = np.abs(at[np.clip(np.searchsorted(at, you)[:, None] + np.array([-1, 0]), 0, len(at) - 1)] - np.array(you)[:, None])
        near = int((gap.min(axis=1) <= NEAR).sum())
    raw = text.translate(_KEEP).split()
    disguised = [w for w in raw if not w.isalnum() or not w.isalpha()]
    inner = [w.strip(_EDGE) for w in disguised]
    mixed = [w for w in inner if w and not w.isalpha() and any(97 <= b <= 122 for b in w) and all(b < 128 for b in w)]
    undone = 0
    for w in mixed:
        plain = w.translate(_UNDO)
        bare = plain.translate(None, b"*.-_~^+=|/\\")
        undone += bare in fixed or bare in learned
    single = [len(w) == 1 for w in raw]
    spaced = sum(map(lambda a, b, c: a and b and c, single, single[1:], single[2:]))
    stretched = sum(any(w[i] == w[i + 1] == w[i + 2] for i in range(len(w) - 2)) for w in mixed) if mixed else 0
    size = len(text)
    share = lambda chars: (size - len(text.translate(None, chars))) / size
    upper_words = sum(w.isupper() and len(w) > 1 for w in text.split())
    return [np.log1p(n), len(hits) / n, float(len(hits)), len(more) / n, float(len(more)), undone / n, len(you) / n, near / n,
            upper_words / n, share(bytes(range(65, 91))), share(b"!?"), share(b".,;:'\"-"), len(mixed) / n, spaced / n, stretched / n]


def describe(docs: DataFrame, learned: list[str]) -> DataFrame:
    """``doc_id, x`` for every row of ``docs``."""
    fixed = frozenset(w.encode() for w in INSULTS)
    extra, person = frozenset(w.encode() for w in learned), frozenset(w.encode() for w in SECOND_PERSON)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                rows = [features(block.text(i), fixed, extra, person) for i in range(len(block.start) - 1)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[block.rows], pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, x array<double>")


def learned_lexicon(docs: DataFrame, sample: DataFrame) -> list[str]:
    """All words and word beginnings typical of toxic texts, by the number of sampled texts that hold them; the sample bounds them."""
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = (Counter(), Counter())

        def rows() -> pa.RecordBatch:
            words = list({*count[0], *count[1]})
            out = pa.RecordBatch.from_arrays([pa.array([w.decode("utf-8", "replace") for w in words], pa.string()),
                                              pa.array([count[1][w] for w in words], pa.int64()), pa.array([count[0][w] for w in words], pa.int64())],
                                             ["word", "toxic", "other"])
            count[0].clear()
            count[1].clear()
            return out

        for batch in batches:
            for block in blocks(batch.column(0)):
                for i, label in enumerate(batch.column(1)[block.rows].to_pylist()):
                    words = {w for w in words_of(block.text(i)) if 2 < len(w) <= 40}
                    count[label].update(words | {x for w in words for x in stems(w)})
                if len(count[0]) + len(count[1]) > 500_000:
                    yield rows()
        yield rows()

    counts = texts.select("text", "label").mapInArrow(run, "word string, toxic long, other long").groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    typical = counts.filter((F.col("toxic") >= 5) & (F.col("toxic") >= 20 * F.col("other")))
    return [r.word for r in typical.orderBy(F.desc("toxic"), "word").collect()]


class Trees(NamedTuple):
    edges: np.ndarray      # bin edges by feature
    feature: np.ndarray    # by tree and inner node, nodes in heap order
    cut: np.ndarray        # go right when the bin is greater
    leaf: np.ndarray       # by tree
    base: float
    knots: np.ndarray      # of the calibration: margin
    level: np.ndarray      # and probability

    def margin(self, x: np.ndarray) -> np.ndarray:
        bins = bin_of(x, self.edges)
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (bins[rows, feature[node]] > cut[node])
            out += leaf[node - (2 ** DEPTH - 1)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.margin(x), self.knots, self.level)


def bin_of(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(edges[f], x[:, f]) for f in range(x.shape[1])], axis=1)


def grow(bins: np.ndarray, gradient: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One tree of full depth by histograms; a node that no cut improves sends everything left."""
    n, d = bins.shape
    inner = 2 ** DEPTH - 1
    feature, cut = np.zeros(inner, dtype=np.int64), np.full(inner, BINS)
    node = np.zeros(n, dtype=np.int64)
    for level in range(DEPTH):
        for at in range(2 ** level - 1, 2 ** (level + 1) - 1):
            mine = np.flatnonzero(node == at)
            best = 1e-6
            if len(mine) >= 2 * LEAST_LEAF:
                g, h = gradient[mine], weight[mine]
                whole = g.sum() ** 2 / (h.sum() + 1)
                for f in range(d):
                    b = bins[mine, f]
                    left_g = np.cumsum(np.bincount(b, g, minlength=BINS + 1))[:-1]
                    left_h = np.cumsum(np.bincount(b, h, minlength=BINS + 1))[:-1]
                    left_n = np.cumsum(np.bincount(b, minlength=BINS + 1))[:-1]
                    gain = left_g ** 2 / (left_h + 1) + (g.sum() - left_g) ** 2 / (h.sum() - left_h + 1) - whole
                    gain[(left_n < LEAST_LEAF) | (len(mine) - left_n < LEAST_LEAF)] = 0
                    if gain.max() > best:
                        best, feature[at], cut[at] = gain.max(), f, gain.argmax()
            node[mine] = 2 * at + 1 + (bins[mine, feature[at]] > cut[at])
    leaf = node - inner
    total_g, total_h = np.bincount(leaf, gradient, minlength=inner + 1), np.bincount(leaf, weight, minlength=inner + 1)
    return feature, cut, RATE * total_g / (total_h + 1)


def isotonic(value: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the best rising step curve (pool adjacent violators), one per block."""
    order = np.argsort(value, kind="stable")
    blocks_: list[list[float]] = []   # sum of labels, rows, sum of values
    for v, y in zip(value[order], label[order]):
        blocks_.append([float(y), 1.0, float(v)])
        while len(blocks_) > 1 and blocks_[-2][0] * blocks_[-1][1] >= blocks_[-1][0] * blocks_[-2][1]:
            top = blocks_.pop()
            blocks_[-1] = [a + b for a, b in zip(blocks_[-1], top)]
    n = np.array([b[1] for b in blocks_])
    # blocks of few rows stay short of certainty
    level = (np.array([b[0] for b in blocks_]) + 0.05) / (n + 0.1)
    return np.array([b[2] for b in blocks_]) / n, np.maximum.accumulate(level)


def fit(x: np.ndarray, label: np.ndarray) -> Trees | None:
    """Trees from four rows in five, calibration from the fifth; None without both classes."""
    if len(x) < 10 or label.min() == label.max():
        return None
    edges = np.stack([np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1]) for f in range(x.shape[1])])
    # rare features have one value almost everywhere: spread the edges over the other values
    for f in range(x.shape[1]):
        others = x[x[:, f] != np.median(x[:, f]), f]
        if len(np.unique(edges[f])) < BINS // 4 and len(others):
            edges[f] = np.sort(np.append(np.quantile(others, np.linspace(0, 1, BINS - 2)), np.median(x[:, f])))
    rest = np.arange(len(x)) % 5 == 4
    if label[~rest].min() == label[~rest].max() or label[rest].min() == label[rest].max():
        rest = np.zeros(len(x), dtype=bool)
    bins, y = bin_of(x[~rest], edges), label[~rest]
    base = float(np.log(y.mean() / (1 - y.mean())))
    margin, made = np.full(len(y), base), []
    rows = np.arange(len(y))
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        feature, cut, leaf = grow(bins, y - p, p * (1 - p))
        node = np.zeros(len(y), dtype=np.int64)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (bins[rows, feature[node]] > cut[node])
        margin += leaf[node - (2 ** DEPTH - 1)]
        made.append((feature, cut, leaf))
    trees = Trees(edges, *(np.array(part) for part in zip(*made)), base, np.zeros(1), np.zeros(1))
    held = rest if rest.any() else ~rest
    knots, level = isotonic(trees.margin(x[held]), label[held])
    return trees._replace(knots=knots, level=level)


def score(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    """``doc_id, score, predicted`` for every whole text; a higher score makes label 1 likelier.

    NULL and empty texts have all features zero and are scored like others; with too few labelled
    rows or one class only, every score is 0.  Repeated rows and missing ids give rows like any others.
    """
    sample = cut_lineage(sample_ids(labels, label, SAMPLE_ROWS))
    for_words = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(5)) < 2
    described = cut_lineage(describe(docs, learned_lexicon(docs, sample.filter(for_words))))
    rows = described.join(F.broadcast(sample.filter(~for_words)), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
    rows = rows.select("x", "label").toPandas()
    model = fit(np.array(rows["x"].tolist()), rows["label"].to_numpy().astype(float)) if len(rows) else None
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(FEATURES))
            value = np.clip(shared.value.score(x), 0, 1) if shared.value is not None else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value), pa.array((value >= THRESHOLD).astype(np.int32))],
                                             ["doc_id", "score", "predicted"])

    return described.mapInArrow(run, "doc_id long, score double, predicted int")
