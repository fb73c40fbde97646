"""Language-model score of whole texts: a unigram model over subwords, summed over all segmentations.

The pieces come from an existing public vocabulary, which is never changed; its scores (negative merge
ranks) set the first weights by Zipf's law, and rounds of expectation maximisation over all training
words refit them.  A text is the string " word word ...", followed by one end symbol.  No piece
crosses a word, so the probability of a text is the product over its words; that of a word is the sum
over all ways to cut it into pieces, by the forward recursion in log space.  Every single byte is a
piece, so every text has a probability.

Words are looked at once each, however often they are found: blocks of texts become word numbers with
an exact dictionary (``wordblocks``).  The dictionaries are dealt into ranges of a word hash, one row for
each block and range; a range adds up the counts, and later brings counts and probabilities of its words
to each block's places, again as one row for each block and range.  Nothing that grows with the corpus
is collected or broadcast; the pieces are bounded by the vocabulary file.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from protolith.session import stored

from .textkit import blocks
from .wordblocks import byte_set, encode_words

BLOCK_BYTES = 8_000_000
#: Bytes of words that share one matrix of arcs.
PART_BYTES = 1 << 15
ROUNDS = 2
#: Word occurrences to a range at most, and the least number of ranges.
RANGE, RANGES = 4_000_000, 256
#: Words of a range that stand in one row.
ROW_WORDS = 20_000
#: Weight of the first weights against the expected counts of the corpus, in pieces.
PRIOR = 1000.0
ZIPF_SHIFT = 2.7
SEPARATORS = byte_set(32, *range(9, 14))
_BLANK, _END = 32, 10


class Pieces(NamedTuple):
    """The vocabulary as a trie: ``edges`` are sorted ``state * 256 + byte``."""
    edges: np.ndarray
    target: np.ndarray
    piece: np.ndarray    # piece that ends in a state, or -1
    first: np.ndarray    # first probabilities by piece
    longest: int


def trie(pieces: dict[bytes, float]) -> Pieces:
    """``pieces`` maps byte strings to scores; higher is likelier.  All single bytes are added, least likely."""
    usable = {p: s for p, s in pieces.items() if p and not any(9 <= b <= 13 for b in p) and _BLANK not in p[1:]}
    low = min(usable.values(), default=0.0) - 1
    for b in range(256):
        if not 9 <= b <= 13:
            usable.setdefault(bytes([b]), low)
    names = sorted(usable)
    order = sorted(range(len(names)), key=lambda i: (-usable[names[i]], names[i]))
    first = np.empty(len(names))
    first[order] = 1 / (np.arange(len(names)) + ZIPF_SHIFT)
    steps: dict[int, int] = {}
    ends = [-1]
    for i, name in enumerate(names):
        state = 0
        for b in name:
            key = state << 8 | b
            if key not in steps:
                steps[key] = len(ends)
                ends.append(-1)
            state = steps[key]
        ends[state] = i
    edges = np.array(sorted(steps), dtype=np.int64)
    target = np.array([steps[k] for k in edges.tolist()], dtype=np.int64)
    return Pieces(edges, target, np.array(ends, dtype=np.int32), first / first.sum(), max(map(len, names)))


def sentencepiece_pieces(path: str) -> dict[bytes, float]:
    """The pieces of a sentencepiece model file as bytes, the word mark as a blank; byte pieces come last."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i)):
            out[model.id_to_piece(i).replace("▁", " ").encode()] = model.get_score(i)
    return out


class Lattice:
    """All arcs of some words: their bytes end to end, each as blank, word, end mark.

    ``at[w]`` is the first node of a word, ``at[w] + size[w]`` its last.  Only the arcs into the nodes
    ``lo <= node < hi`` are held.
    """

    def __init__(self, pieces: Pieces, letters: np.ndarray, lo: int, hi: int):
        self.lo = lo
        begin = max(lo - pieces.longest, 0)
        alive = np.arange(begin, hi)
        state = np.zeros(len(alive), dtype=np.int64)
        columns = []
        for length in range(1, pieces.longest + 1):
            inside = alive + length < len(letters)
            alive, state = alive[inside], state[inside]
            key = state << 8 | letters[alive + length - 1]
            found = np.minimum(np.searchsorted(pieces.edges, key), len(pieces.edges) - 1)
            ok = pieces.edges[found] == key
            alive, state = alive[ok], pieces.target[found[ok]]
            if not len(alive):
                break
            column = np.full(hi - lo, -1, dtype=np.int32)
            into = alive + length - lo
            mine = (into >= 0) & (into < hi - lo)
            column[into[mine]] = pieces.piece[state[mine]]
            columns.append(column)
        self.arcs = np.stack(columns, axis=1) if columns else np.full((hi - lo, 1), -1, dtype=np.int32)


def _log_sum(values: np.ndarray) -> np.ndarray:
    top = values.max(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        out = top + np.log(np.exp(values - top[:, None]).sum(axis=1))
    return np.where(np.isneginf(top), top, out)


class Batch:
    """Some words, longest first, and their recursions under given log weights."""

    def __init__(self, pieces: Pieces, words: list[bytes]):
        self.pieces = pieces
        self.order = np.array(sorted(range(len(words)), key=lambda i: -len(words[i])), dtype=np.int64)
        self.letters = np.frombuffer(b"".join(b" " + words[i] + b"\n" for i in self.order.tolist()), dtype=np.uint8).astype(np.int64)
        self.size = np.array([len(words[i]) + 1 for i in self.order.tolist()], dtype=np.int64)
        self.at = np.cumsum(self.size + 1) - self.size - 1
        # many words share one piece of the nodes; a very long word is cut into several
        n = len(self.letters)
        single = len(words) == 1
        self.cuts = list(range(0, n, PART_BYTES)) + [n] if single else [0, n]

    def parts(self, backward: bool = False) -> Iterator[tuple[int, int, Lattice]]:
        spans = list(zip(self.cuts[:-1], self.cuts[1:]))
        for lo, hi in reversed(spans) if backward else spans:
            yield lo, hi, Lattice(self.pieces, self.letters, lo, hi)

    def steps(self, lo: int, hi: int) -> range:
        """Distances from a word's first node that the nodes ``lo .. hi - 1`` can have."""
        return range(lo, hi) if len(self.size) == 1 else range(int(self.size[0]) + 1)

    def forward(self, weight: np.ndarray) -> np.ndarray:
        """Log probability of the way from a word's first node to each node."""
        alpha = np.full(len(self.letters), -np.inf)
        alpha[self.at] = 0.0
        for lo, hi, held in self.parts():
            for t in self.steps(lo, hi):
                if t == 0:
                    continue
                node = self.at[:np.searchsorted(-self.size, -t, "right")] + t
                if not len(node):
                    break
                k = min(t, held.arcs.shape[1])
                alpha[node] = _log_sum(alpha[node[:, None] - np.arange(1, k + 1)] + weight[held.arcs[node - lo, :k]])
        return alpha

    def expected(self, weight: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Expected uses of each piece, words weighted by ``count``."""
        alpha = self.forward(weight)
        total = alpha[self.at + self.size]
        word = np.repeat(np.arange(len(self.size)), self.size + 1)
        beta = np.full(len(self.letters), -np.inf)
        beta[self.at + self.size] = 0.0
        out = np.zeros(len(weight) - 1)
        weighted = count[self.order]
        for lo, hi, held in self.parts(backward=True):
            # what flows out of the nodes below is the sum over arcs into nodes not yet left behind
            for t in reversed(self.steps(lo, hi)):
                node = self.at[:np.searchsorted(-self.size, -t, "right")] + t
                if t == 0 or not len(node):
                    continue
                k = min(t, held.arcs.shape[1])
                source = node[:, None] - np.arange(1, k + 1)
                flow = weight[held.arcs[node - lo, :k]] + beta[node][:, None]
                # each source is reached by one arc of each length, so no two rows of a column collide
                for j in range(k):
                    beta[source[:, j]] = np.logaddexp(beta[source[:, j]], flow[:, j])
            row, column = np.nonzero(held.arcs >= 0)
            piece, node = held.arcs[row, column], row + lo
            ways = alpha[node - column - 1] + weight[piece] + beta[node] - total[word[node]]
            out += np.bincount(piece, weights=np.exp(ways) * weighted[word[node]], minlength=len(out))
        return out

    def probability(self, weight: np.ndarray) -> np.ndarray:
        """Log probability of each word, in the order given."""
        out = np.empty(len(self.size))
        out[self.order] = self.forward(weight)[self.at + self.size]
        return out


def batches_of(words: list[bytes]) -> Iterator[slice]:
    """Runs of words of at most PART_BYTES; a longer word is alone."""
    lo, held = 0, 0
    for i, word in enumerate(words):
        if i > lo and held + len(word) + 2 > PART_BYTES:
            yield slice(lo, i)
            lo, held = i, 0
        held += len(word) + 2
    if lo < len(words):
        yield slice(lo, len(words))


def log_weights(share: np.ndarray, end: float) -> np.ndarray:
    """Log weights of the pieces; one more entry stands for no arc."""
    with np.errstate(divide="ignore"):
        return np.append(np.log(share) + math.log1p(-end), -np.inf)


def _lists(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """Runs of ``values`` from ``at`` to the next as list rows."""
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values))


def text_blocks(docs: DataFrame) -> DataFrame:
    """``block, ids, held, learn, n, codes, words, found``: texts as word numbers, with the dictionary of
    each block and how often its words are found in texts to learn from."""
    names = ["ids", "held", "learn", "n", "codes", "words", "found"]
    schema = "ids array<long>, held array<boolean>, learn array<boolean>, n array<int>, codes binary, words array<binary>, found array<long>"

    def listed(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(3), BLOCK_BYTES):
                rows = block.rows
                words = encode_words(block, SEPARATORS)
                learn = batch.column(2)[rows].to_numpy(zero_copy_only=False).astype(bool)
                found = np.bincount(words.code[learn[words.owner]], minlength=len(words.words))
                n = np.bincount(words.owner, minlength=len(learn)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    listed(batch.column(0)[rows]), listed(batch.column(1)[rows]), listed(pa.array(learn)), listed(pa.array(n)),
                    pa.array([words.code.tobytes()], pa.binary()), listed(words.words.cast(pa.binary())), listed(pa.array(found.astype(np.int64)))], names)

    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(fold == 1, F.lit(False)).alias("held"),
                       F.coalesce(fold != 1, F.lit(False)).alias("learn"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id())


def dealt_words(cut: DataFrame, ranges: int) -> DataFrame:
    """``range, block, places, words, found``: the dictionary of each block, a row for each range of word hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words = batch.column(1)[i].values
                if not len(words):
                    continue
                each = np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_pylist()), dtype=np.uint64, count=len(words)) % np.uint64(ranges)
                order = np.argsort(each, kind="stable")
                full, at = np.unique(each[order], return_index=True)
                at = np.append(at, len(order))
                taken = words.take(pa.array(order))
                yield pa.RecordBatch.from_arrays([
                    pa.array(full.astype(np.int32)), pa.array([batch.column(0)[i].as_py()] * len(full), pa.int64()),
                    _lists(order.astype(np.int32), at), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), taken),
                    _lists(batch.column(2)[i].values.to_numpy()[order], at)], ["range", "block", "places", "words", "found"])

    return cut.select("block", "words", "found").mapInArrow(run, "range int, block long, places array<int>, words array<binary>, found array<long>")


def _row(batch: pa.RecordBatch, column: int, i: int) -> pa.Array:
    return batch.column(column)[i].values


def word_counts(dealt: DataFrame) -> DataFrame:
    """``range, words, counts``: the distinct words of a range with their counts in training texts, in rows of bounded size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, defaultdict(int)

        def counted() -> Iterator[pa.RecordBatch]:
            words, counts = list(total), list(total.values())
            for lo in range(0, len(words), ROW_WORDS):
                part = words[lo:lo + ROW_WORDS]
                yield pa.RecordBatch.from_arrays([
                    pa.array([now], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), pa.array(part, pa.binary())),
                    _lists(np.array(counts[lo:lo + ROW_WORDS], dtype=np.int64), np.array([0, len(part)]))], ["range", "words", "counts"])

        for batch in batches:
            for i in range(batch.num_rows):
                here = batch.column(0)[i].as_py()
                if here != now:
                    yield from counted()
                    now, total = here, defaultdict(int)
                for word, n in zip(_row(batch, 1, i).to_pylist(), _row(batch, 2, i).to_pylist()):
                    total[word] += n
        yield from counted()

    rows = dealt.select("range", "words", "found").repartition("range").sortWithinPartitions("range")
    return rows.mapInArrow(run, "range int, words array<binary>, counts array<long>")


def facts_of_blocks(dealt: DataFrame, judged: DataFrame) -> DataFrame:
    """``block, places, counts, logs``: what a range's table ``range, words, counts, logs`` says about a block's words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at, counts, logs = None, {}, [], []
        for batch in batches:
            for i in range(batch.num_rows):
                here, block = batch.column(0)[i].as_py(), batch.column(1)[i]
                if here != now:
                    now, at, counts, logs = here, {}, [], []
                if not block.is_valid:
                    # rows of the table come first
                    for word in _row(batch, 3, i).to_pylist():
                        at[word] = len(at)
                    counts.append(_row(batch, 4, i).to_numpy())
                    logs.append(_row(batch, 5, i).to_numpy())
                    continue
                if len(counts) > 1:
                    counts, logs = [np.concatenate(counts)], [np.concatenate(logs)]
                words = _row(batch, 3, i)
                where = np.fromiter(map(at.__getitem__, words.to_pylist()), dtype=np.int64, count=len(words))
                ends = np.array([0, len(where)])
                yield pa.RecordBatch.from_arrays([
                    pa.array([block.as_py()], pa.int64()), _lists(_row(batch, 2, i).to_numpy(), ends), _lists(counts[0][where], ends), _lists(logs[0][where], ends)],
                    ["block", "places", "counts", "logs"])

    empty = F.lit(None)
    table = judged.select("range", empty.cast("long").alias("block"), empty.cast("array<int>").alias("places"), "words", "counts", "logs")
    rows = dealt.select("range", "block", "places", "words", empty.cast("array<long>").alias("counts"), empty.cast("array<double>").alias("logs"))
    line = table.unionByName(rows).repartition("range").sortWithinPartitions(F.col("range"), F.col("block").asc_nulls_first())
    return line.mapInArrow(run, "block long, places array<int>, counts array<long>, logs array<double>")


def fit(counted: DataFrame, pieces: Pieces, texts: int, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Shares of the pieces and the share of the end symbol, from training words ``words, counts``."""
    spark = counted.sparkSession
    shared = spark.sparkContext.broadcast(pieces)
    share, end = pieces.first, 0.5
    for _ in range(rounds):
        weight = spark.sparkContext.broadcast(log_weights(share, 0.0))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(shared.value.first))
            for batch in batches:
                for i in range(batch.num_rows):
                    count = _row(batch, 1, i).to_numpy().astype(np.float64)
                    learned = np.flatnonzero(count)
                    words, count = _row(batch, 0, i).take(pa.array(learned)).to_pylist(), count[learned]
                    for part in batches_of(words):
                        total += Batch(shared.value, words[part]).expected(weight.value, count[part])
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["piece", "uses"])

        found = counted.select("words", "counts").mapInArrow(run, "piece long, uses double").groupBy("piece").agg(F.sum("uses").alias("uses")).toArrow()
        uses = np.zeros(len(share))
        uses[found.column("piece").to_numpy()] = found.column("uses").to_numpy()
        share = (uses + PRIOR * pieces.first) / (uses.sum() + PRIOR)
        end = (texts + 0.5) / (texts + uses.sum() + 1)
    return share, end


def score_texts(docs: DataFrame, vocabulary: str, rounds: int = ROUNDS) -> DataFrame:
    """Log10 probabilities of every text.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, one row for each row
    of ``docs``.  Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, followed by one end.  A NULL text is empty: one
    token.  Rows whose crc32(doc_id) modulo 5 is 1 are held out, all others with an id are
    learned from, repeated rows as often as they stand there; rows without an id are scored only.  With nothing to
    learn from, counts are 0 and the first weights score.  A very long text is a block of its own,
    a very long word is gone through in parts.  Columns other than ``doc_id`` and ``text`` may have any name.
    """
    spark = docs.sparkSession
    pieces = trie(sentencepiece_pieces(vocabulary))
    cut = stored(text_blocks(docs), "text-blocks")
    size = cut.agg(F.sum(F.size(F.filter("learn", lambda x: x))).alias("texts"), F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)).alias("words")).first()
    texts, ranges = size.texts or 0, max(RANGES, (size.words or 0) // RANGE)
    dealt = dealt_words(cut, ranges)
    counted = stored(word_counts(dealt), "word-counts")
    sums = counted.select(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("words"), F.size(F.filter("counts", lambda x: x > 0)).alias("distinct")).agg(
        F.sum("words").alias("words"), F.sum("distinct").alias("distinct")).first()
    train_tokens, distinct = (sums.words or 0) + texts, (sums.distinct or 0) + (texts > 0)

    share, end = fit(counted, pieces, texts, rounds)
    shared, weight = spark.sparkContext.broadcast(pieces), spark.sparkContext.broadcast(log_weights(share, end))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words = _row(batch, 1, i).to_pylist()
                logs = np.concatenate([Batch(shared.value, words[part]).probability(weight.value) for part in batches_of(words)])
                yield pa.RecordBatch.from_arrays([*(batch.column(j).slice(i, 1) for j in range(3)), _lists(logs, np.array([0, len(logs)]))],
                                                 ["range", "words", "counts", "logs"])

    judged = counted.mapInArrow(judge, "range int, words array<binary>, counts array<long>, logs array<double>")
    facts = facts_of_blocks(dealt, judged)
    smooth = math.log10(train_tokens + 0.5 * (distinct + 1))
    end_base = math.log10(texts + 0.5) - smooth
    end_score = math.log10(end)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for i in range(batch.num_rows):
                if not batch.column(1)[i].is_valid:
                    # facts of a block come ahead of its texts
                    held.append(tuple(_row(batch, j, i).to_numpy().copy() for j in (5, 6, 7)))
                    continue
                ids, held_out, n = (batch.column(j)[i].values for j in (1, 2, 3))
                size = sum(len(x[0]) for x in held)
                base, p, known = np.zeros(size), np.zeros(size), np.zeros(size)
                for place, count, log in held:
                    base[place], p[place], known[place] = np.log10(count + 0.5) - smooth, log, count > 0
                held = []
                n = n.to_numpy()
                owner = np.repeat(np.arange(len(n)), n)
                code = np.frombuffer(batch.column(4)[i].as_buffer(), dtype=np.int32)
                add = lambda x: np.bincount(owner, weights=x[code], minlength=len(n))
                yield pa.RecordBatch.from_arrays([
                    ids, held_out, pa.array(n.astype(np.int64) + 1), pa.array(add(known).astype(np.int64) + (texts > 0)),
                    pa.array(add(base) + end_base), pa.array(add(p) / math.log(10) + end_score)],
                    ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    def nothing(kind: str) -> Column:
        return F.lit(None).cast(kind)

    lists = {"ids": "array<long>", "held": "array<boolean>", "n": "array<int>", "codes": "binary"}
    said = {"places": "array<int>", "counts": "array<long>", "logs": "array<double>"}
    line = facts.select("block", *(nothing(t).alias(c) for c, t in lists.items()), *said).unionByName(
        cut.select("block", *lists, *(nothing(t).alias(c) for c, t in said.items())))
    line = line.withColumn("last", F.col("ids").isNotNull()).repartition("block").sortWithinPartitions("block", "last")
    out = line.select("block", *lists, *said).mapInArrow(
        add_up, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(train_tokens).cast("long")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
