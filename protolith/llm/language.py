"""Language identification: interpolated Kneser-Ney models over characters, one per language.

Every training text is counted, in grams of ``ORDER`` folded characters (lower case, letters only,
one blank for everything else).  Lower orders take continuation counts, as Kneser and Ney have it.
The fitted model holds sorted arrays of grams, each with the log probabilities of the languages that
have it, and grows with what the texts hold: no gram and no language is left out.  A text takes the
language with the lowest cross-entropy per character.  How far the
cross-entropy of a text may lie above that of its language's own training text is known from the
mean and spread of the log probabilities there; beyond it the text is marked ``rejected`` and its
score falls.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import BLOCK_BYTES, Block, blocks, may_learn, ranges

ORDER = 4
#: Grams that a counting task holds before it passes them on.
HELD = 2_000_000
REJECT_SIGMAS = 6.0
REJECT_MARGIN = 0.75
SURE_CHARS = 60
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)]))
    return _letters[0]


class Folded(NamedTuple):
    codes: np.ndarray   # uint64, one per predicted character: the last ORDER characters
    start: np.ndarray   # bounds of the texts among them
    letters: np.ndarray  # letters in each text


def fold_block(block: Block) -> Folded:
    texts = ["\n" + block.text(i).decode("utf-8", "replace").lower() + " " for i in range(len(block.start) - 1)]
    raw = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), dtype=np.uint32)
    begin = np.cumsum([0, *map(len, texts)])
    letter = letters()[raw]
    keep = letter.copy()
    keep[1:] |= letter[:-1]      # one blank behind a run of letters
    keep[begin[:-1]] = True
    char = np.where(letter, raw ^ (raw >> 16), 32)[keep] & 0xFFFF
    at = np.cumsum(keep) - 1
    begin_kept = np.append(at[begin[:-1]], len(char))
    again = np.ones(len(char), dtype=np.int64)
    again[begin_kept[:-1]] = ORDER - 1
    char = np.repeat(char, again).astype(np.uint64)
    start = begin_kept + np.arange(len(begin_kept)) * (ORDER - 2)
    codes = char[ORDER - 1:].copy() if len(char) >= ORDER else np.zeros(0, np.uint64)
    for back in range(1, ORDER):
        codes |= char[ORDER - 1 - back:len(char) - back] << np.uint64(16 * back)
    inside = np.ones(len(char), dtype=bool)
    for shift in range(ORDER - 1):
        inside[start[:-1] + shift] = False
    mine = np.cumsum(np.append(0, inside))
    total = np.append(0, np.cumsum(letter))
    return Folded(codes[inside[ORDER - 1:]], mine[start], total[begin[1:]] - total[begin[:-1]])


def gram_counts(training: DataFrame) -> DataFrame:
    """``lang, gram, n`` over all training texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(lang: str) -> tuple[np.ndarray, np.ndarray]:
            grams, where = np.unique(np.concatenate([g for g, _ in held[lang]]), return_inverse=True)
            return grams, np.bincount(where, np.concatenate([n for _, n in held[lang]])).astype(np.int64)

        def rows() -> Iterator[pa.RecordBatch]:
            for lang in list(held):
                grams, n = merged(lang)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n)],
                                                 ["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            for block in blocks(batch.column(0)):
                names = np.array(batch.column(1)[block.rows].to_pylist(), dtype=object)
                folded = fold_block(block)
                of = np.repeat(np.arange(len(names)), np.diff(folded.start))
                for lang in sorted(set(names)):
                    part = np.unique(folded.codes[(names == lang)[of]], return_counts=True)
                    held.setdefault(lang, []).append(part)
                    if len(held[lang]) > 8:
                        held[lang] = [merged(lang)]
            if sum(len(g) for parts in held.values() for g, _ in parts) > HELD:
                yield from rows()
        yield from rows()

    return training.select("text", "lang").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class SparseRows:
    """Values by gram and language, held for the pairs that occur: sorted grams, and the entries of each."""

    def __init__(self, grams: list[np.ndarray], values: list[np.ndarray]):
        gram = np.concatenate(grams)
        lang = np.repeat(np.arange(len(grams), dtype=np.int32), [len(g) for g in grams])
        by = np.argsort(gram, kind="stable")
        self.lang, self.value = lang[by], np.concatenate(values)[by].astype(np.float32)
        self.grams, first = np.unique(gram[by], return_index=True)
        self.first = np.append(first, len(gram))

    def entries(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the gram, language and value of every entry of ``grams``."""
        if not len(self.grams):
            return np.zeros(0, np.int64), self.lang, self.value
        row = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        hit = np.flatnonzero(self.grams[row] == grams)
        many = self.first[row[hit] + 1] - self.first[row[hit]]
        at = ranges(self.first[row[hit]], many)
        return np.repeat(hit, many), self.lang[at], self.value[at]


class Model(NamedTuple):
    languages: list[str]
    probability: list[SparseRows]     # by order from 1: log p of a gram's last character after the others
    backoff: list[SparseRows]         # by order from 2: log of the mass a context leaves to the lower order
    floor: np.ndarray                 # log p of a character never seen
    mean: np.ndarray                  # cross-entropy of each language's own training text
    spread: np.ndarray

    def log_p(self, codes: np.ndarray) -> np.ndarray:
        """Log probability of the last character of each gram, per language."""
        out = np.tile(self.floor, (len(codes), 1))
        for order in range(1, ORDER + 1):
            part = codes & np.uint64((1 << 16 * order) - 1)
            if order > 1:
                row, lang, left = self.backoff[order - 2].entries(part >> np.uint64(16))
                out[row, lang] += left
            row, lang, value = self.probability[order - 1].entries(part)
            out[row, lang] = value
        return out


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]]) -> Model | None:
    """A model from ``(language, sorted grams, counts)``; None when there is nothing to learn from."""
    rows = [r for r in rows if len(r[1])]
    if not rows:
        return None
    letters_seen = len(np.unique(np.concatenate([np.unique(g & np.uint64(0xFFFF)) for _, g, _ in rows]))) + 1
    grams, logs = [[] for _ in range(ORDER + 1)], [[] for _ in range(ORDER + 1)]
    contexts, backoff = [[] for _ in range(ORDER + 1)], [[] for _ in range(ORDER + 1)]
    floor, mean, spread = np.zeros(len(rows)), np.zeros(len(rows)), np.zeros(len(rows))
    for lang, (_, seen, n) in enumerate(rows):
        gram, count = [seen] * (ORDER + 1), [n.astype(float)] * (ORDER + 1)
        for order in range(ORDER - 1, 0, -1):  # continuation counts
            gram[order], many = np.unique(gram[order + 1] & np.uint64((1 << 16 * order) - 1), return_counts=True)
            count[order] = many.astype(float)
        p = np.zeros(0)
        for order in range(1, ORDER + 1):
            c = count[order]
            ones, twos = (c == 1).sum(), (c == 2).sum()
            discount = min(max(ones / (ones + 2 * twos), 0.1), 0.9) if ones and twos else 0.5
            if order == 1:
                total, lower = c.sum(), 1 / letters_seen
                rest = discount * len(c) / total
                floor[lang] = np.log(rest / letters_seen)
            else:
                context, of = np.unique(gram[order] >> np.uint64(16), return_inverse=True)
                sums = np.bincount(of, c)
                share = discount * np.bincount(of) / sums
                contexts[order].append(context)
                backoff[order].append(np.log(share))
                total, rest = sums[of], share[of]
                lower = p[np.searchsorted(gram[order - 1], gram[order] & np.uint64((1 << 16 * (order - 1)) - 1))]
            p = np.maximum(c - discount, 0) / total + rest * lower
            grams[order].append(gram[order])
            logs[order].append(np.log(p))
        cross = -np.log(p)
        mean[lang] = np.average(cross, weights=n)
        spread[lang] = np.sqrt(np.average((cross - mean[lang]) ** 2, weights=n))
    return Model([r[0] for r in rows], [SparseRows(grams[k], logs[k]) for k in range(1, ORDER + 1)],
                 [SparseRows(contexts[k], backoff[k]) for k in range(2, ORDER + 1)], floor.astype(np.float32), mean, spread)


def learn(docs: DataFrame) -> Model | None:
    """Count all training texts (``lang`` known) and fit a model of all their grams and languages."""
    counts = gram_counts(docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()))
    table = counts.toArrow()
    lang = table.column("lang").combine_chunks().dictionary_encode()
    names, of = lang.dictionary.to_pylist(), lang.indices.to_numpy()
    grams, n = table.column("gram").to_numpy().view(np.uint64), table.column("n").to_numpy()
    by = np.lexsort((grams, of))
    bounds = np.searchsorted(of[by], np.arange(len(names) + 1))
    parts = []
    for name, lo, hi in sorted(zip(names, bounds[:-1].tolist(), bounds[1:].tolist())):
        parts.append((name, grams[by[lo:hi]], n[by[lo:hi]]))
    return fit(parts)


def score_block(model: Model | None, block: Block) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Language, score, cross-entropy and rejection of each text of a block."""
    n = len(block.start) - 1
    entropy, score, rejected, best = np.zeros(n), np.zeros(n), np.zeros(n, bool), np.full(n, -1)
    folded = fold_block(block) if model else None
    known = np.flatnonzero(folded.letters > 0) if model else np.zeros(0, np.int64)
    if len(known):
        size = np.diff(folded.start)
        codes, where = np.unique(folded.codes, return_inverse=True)
        log_p = model.log_p(codes)
        cross = np.zeros((n, len(model.languages)))
        for lang in range(len(model.languages)):
            sums = np.add.reduceat(log_p[:, lang][where], folded.start[:-1][size > 0], dtype=np.float64)
            cross[size > 0, lang] = -sums / size[size > 0]
        cross, size = cross[known], size[known]
        best[known] = cross.argmin(axis=1)
        low = cross.min(axis=1)
        weight = np.exp(-(cross - low[:, None]) * np.minimum(size, SURE_CHARS)[:, None])
        lang = best[known]
        limit = model.mean[lang] + REJECT_MARGIN + REJECT_SIGMAS * model.spread[lang] / np.sqrt(size)
        over = np.maximum(low - limit, 0)
        entropy[known], rejected[known] = low, over > 0
        score[known] = np.exp(-over) / weight.sum(axis=1)
    return [model.languages[b] if b >= 0 else "und" for b in best.tolist()], score, entropy, rejected


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, lang_pred, score, cross_entropy, rejected`` for every whole text, from the text alone.

    ``und`` with score 0 where the text is NULL or has no letter, or nothing could be learned.  Equal
    cross-entropies give the first language by name.  Repeated rows and missing ids give rows like
    any others; other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # smaller blocks for many languages: each gram of a block has a value for every language
    limit = BLOCK_BYTES * 8 // max(8, len(model.languages) if model else 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1), limit):
                lang, score, entropy, rejected = score_block(shared.value, block)
                yield pa.RecordBatch.from_arrays([batch.column(0)[block.rows], pa.array(lang, pa.string()), pa.array(score),
                                                  pa.array(entropy), pa.array(rejected)],
                                                 ["doc_id", "lang_pred", "score", "cross_entropy", "rejected"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean")


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(may_learn("doc_id")).select("text", "lang")
