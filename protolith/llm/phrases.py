"""Phrase collocations: frequent word runs that hold together better than their parts.

Texts are cut into pieces at ``.,;:!?`` and line breaks, pieces into words at blanks and tabs.
The steps, all by language:

1. Blocks of texts become word numbers with an exact dictionary each (``wordblocks``), written once.
2. Length by length, numpy prefix polynomials modulo two primes give every run of words a
   Rabin-Karp fingerprint; equal ones are counted inside the block, and a shuffle adds up the blocks'
   counts.  A run of ``k`` words can only be frequent if both runs of ``k - 1`` words in it are, so a
   table of ``FILTER_BITS`` bits, set for the frequent fingerprints of the length before, keeps the rest
   from being shuffled.  The table has a fixed size; a full table lets more rows through and loses
   none.
3. A last scan looks at the runs with a bit in the table.  Fingerprints are checked against the words:
   occurrences of one fingerprint in a block are compared word by word with the first of them, at whose
   place the phrase is cut out of the text, and counts of blocks are added up by phrase, not by
   fingerprint.  So a collision can cost a few rows but never changes a count.
4. Scores, containment and ranks are joins over the frequent phrases.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from protolith.session import stored

from .textkit import blocks, mix
from .wordblocks import byte_set, encode_words, pack_words, unpack_words

BREAKS = byte_set(*b".,;:!?", *range(10, 14))
SEPARATORS = BREAKS | byte_set(32, 9)
BLOCK_BYTES = 2_000_000
#: Rows of an Arrow batch that are sorted into languages at a time.
SLICE = 500
FILTER_BITS = 1 << 26
#: Fingerprints that meet in one step of a sum, and bits of the least number of their ranges.
RANGE, RANGE_BITS = 1_000_000, 8
#: Part ranks within a language before the last one, so that no task ranks all phrases of a language.
SALTS = 64
MISSING = "und"

PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_000_003_919, 1_736_504_101)
_powers: dict[tuple[int, bool], np.ndarray] = {}


def _power(which: int, n: int, inverse: bool = False) -> np.ndarray:
    """Powers of a base (or of its inverse) modulo its prime, by doubling."""
    have = _powers.get((which, inverse))
    if have is None or len(have) < n:
        p = np.uint64(PRIMES[which])
        step = pow(BASES[which], -1, PRIMES[which]) if inverse else BASES[which]
        have = np.ones(1, dtype=np.uint64)
        while len(have) < n:
            have = np.concatenate([have, have * np.uint64(pow(step, len(have), PRIMES[which])) % p])
        _powers[which, inverse] = have
    return have[:n]


class Prefixes:
    """Fingerprints of any run of symbols from prefix sums of a polynomial, modulo two primes."""

    def __init__(self, symbols: tuple[np.ndarray, np.ndarray]):
        self.sums = []
        for which, values in enumerate(symbols):
            sums = np.zeros(len(values) + 1, dtype=np.uint64)
            np.cumsum(values * _power(which, len(values)) % np.uint64(PRIMES[which]), out=sums[1:])
            self.sums.append(sums)

    def at(self, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = []
        for which, sums in enumerate(self.sums):
            p = np.uint64(PRIMES[which])
            down = _power(which, len(sums), inverse=True)
            parts.append((sums[stop] - sums[start]) % p * down[start] % p)
        return parts[0], parts[1]


class Runs:
    """The word runs of one block."""

    def __init__(self, lang: str, codes: pa.Buffer, words: pa.Buffer, offsets: pa.Buffer):
        self.lang = lang
        self.code = np.frombuffer(codes, dtype=np.int32)
        self.letters, self.offsets = unpack_words(words, offsets)
        # a word is the fingerprint of its bytes, plus one so that no symbol is zero
        letters = Prefixes((self.letters.astype(np.uint64) + np.uint64(1),) * 2).at(self.offsets[:-1], self.offsets[1:])
        lengths = np.diff(self.offsets).astype(np.uint64)
        symbols = tuple((x + lengths) % np.uint64(p) + np.uint64(1) for x, p in zip(letters, PRIMES))
        at = np.maximum(self.code, 0)
        self.prefixes = Prefixes(tuple(x[at] if len(x) else np.zeros(0, np.uint64) for x in symbols))
        self.salt = np.uint64(xxhash.xxh64_intdigest(lang.encode()))
        self.breaks = np.concatenate([[0], np.cumsum(self.code < 0)])

    def fingerprints(self, k: int) -> np.ndarray:
        """Of all runs of ``k`` symbols by start, breaks not minded."""
        n = max(len(self.code) - k + 1, 0)
        start = np.arange(n)
        a, b = self.prefixes.at(start, start + k)
        return mix(((a << np.uint64(31)) ^ b) ^ (self.salt + np.uint64(k)))

    def whole(self, k: int) -> np.ndarray:
        """Which runs lie within one piece."""
        n = max(len(self.code) - k + 1, 0)
        return self.breaks[k:k + n] == self.breaks[:n]

    def likely(self, k: int, table: np.ndarray | None) -> np.ndarray:
        """Starts of the runs whose two runs of ``k - 1`` words have a bit."""
        ok = self.whole(k)
        if k > 1 and table is not None:
            below = has_bit(table, self.fingerprints(k - 1))
            ok &= below[:len(ok)] & below[1:len(ok) + 1]
        return np.flatnonzero(ok)

    def text(self, start: int, k: int) -> bytes:
        return b" ".join([self.letters[self.offsets[c]:self.offsets[c + 1]].tobytes() for c in self.code[start:start + k].tolist()])

    def phrases(self, k: int, table: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Runs of ``k`` words with a bit: sorted fingerprints, first places and counts in the block.

        All occurrences behind one place have the same words; others with the same fingerprint come in another turn.
        """
        prints = self.fingerprints(k)
        start = np.flatnonzero(self.whole(k) & has_bit(table, prints))
        while len(start):
            each, first, which = np.unique(prints[start], return_index=True, return_inverse=True)
            pointer = start[first]
            same = np.ones(len(start), dtype=bool)
            for i in range(k):
                same &= self.code[start + i] == self.code[pointer[which] + i]
            yield each, pointer, np.bincount(which[same], minlength=len(first))
            start = start[~same]


def all_runs(batch: pa.RecordBatch) -> Iterator[Runs]:
    """One block after the other, read where Arrow holds it."""
    for i in range(batch.num_rows):
        yield Runs(batch.column(0)[i].as_py(), *(batch.column(j)[i].as_buffer() for j in (1, 2, 3)))


def has_bit(table: np.ndarray, prints: np.ndarray) -> np.ndarray:
    slot = prints & np.uint64(len(table) * 64 - 1)
    return (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def word_blocks(docs: DataFrame) -> DataFrame:
    """``block, lang, n, codes, words, offsets``: word numbers with -1 where a piece ends."""
    def cut(lang: str, texts: pa.Array) -> Iterator[tuple]:
        for block in blocks(texts, BLOCK_BYTES):
            found = encode_words(block, SEPARATORS)
            n = len(found.code)
            if not n:
                continue
            ends = np.flatnonzero(BREAKS[block.data])
            new = np.searchsorted(ends, found.start[1:]) > np.searchsorted(ends, found.stop[:-1])
            new |= found.owner[1:] != found.owner[:-1]
            codes = np.insert(found.code, np.flatnonzero(new) + 1, -1).astype(np.int32)
            letters, offsets = pack_words(found.words)
            yield lang, n, codes.tobytes(), letters.tobytes(), offsets.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.Array]] = {}
        size: dict[str, int] = {}

        def out(langs: list[str]) -> Iterator[pa.RecordBatch]:
            for lang in langs:
                size.pop(lang)
                for row in cut(lang, pa.chunked_array(held.pop(lang))):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row[0]], pa.string()), pa.array([row[1]], pa.int64()), *(pa.array([x], pa.binary()) for x in row[2:])],
                        ["lang", "n", "codes", "words", "offsets"])

        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                langs, texts = part.column(0).dictionary_encode(), part.column(1).cast(pa.large_string())
                which = langs.indices.to_numpy(zero_copy_only=False)
                for i, lang in enumerate(langs.dictionary.to_pylist()):
                    mine = texts.filter(pa.array(which == i))
                    held.setdefault(lang, []).append(mine)
                    size[lang] = size.get(lang, 0) + mine.nbytes
                    if size[lang] >= BLOCK_BYTES:
                        yield from out([lang])
                if sum(size.values()) >= 4 * BLOCK_BYTES:
                    yield from out(list(held))
        yield from out(list(held))

    rows = docs.select(F.coalesce("lang", F.lit(MISSING)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "lang string, n long, codes binary, words binary, offsets binary")


def _binary(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """Runs of ``values`` from ``at`` to the next as binary rows, without a copy of each."""
    offsets = (at * values.itemsize).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)]).cast(pa.binary())


def _sums(prints: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints with their total counts."""
    every, count = np.concatenate(prints), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every, count = every[order], count[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    return every[first], np.add.reduceat(count, first)


def frequent_prints(cut: DataFrame, k: int, least: int, table, words: int) -> DataFrame:
    """Fingerprints of runs of ``k`` words found ``least`` times or more over all blocks: ``print, f``.

    A block sends its distinct fingerprints with their counts as one row for each range of the
    fingerprint; there are so many ranges that one holds about ``RANGE`` of all ``words`` at most.
    """
    bits = max((words // RANGE).bit_length(), RANGE_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
        for batch in batches:
            for runs in all_runs(batch):
                start = runs.likely(k, None if table is None else table.value)
                prints, count = np.unique(runs.fingerprints(k)[start], return_counts=True)
                at = np.append(np.searchsorted(prints, edges), len(prints))
                full = np.flatnonzero(at[1:] > at[:-1])
                if len(full):
                    at = np.append(at[full], len(prints))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(full.astype(np.int32)), _binary(prints, at), _binary(count.astype(np.int32), at)], ["range", "prints", "counts"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, prints, counts, held = None, [], [], 0

        def frequent() -> pa.RecordBatch:
            every, total = _sums(prints, counts) if prints else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            many = total >= least
            return pa.RecordBatch.from_arrays([pa.array(every[many].view(np.int64)), pa.array(total[many])], ["print", "f"])

        for batch in batches:
            for i in range(batch.num_rows):
                here = batch.column(0)[i].as_py()
                if here != now:
                    yield frequent()
                    now, prints, counts, held = here, [], [], 0
                prints.append(np.frombuffer(batch.column(1)[i].as_buffer(), np.uint64).copy())
                counts.append(np.frombuffer(batch.column(2)[i].as_buffer(), np.int32).astype(np.int64))
                held += len(prints[-1])
                if held > 4 * RANGE:
                    prints, counts = map(list, zip(_sums(prints, counts)))
                    held = 0
        yield frequent()

    rows = cut.select("lang", "codes", "words", "offsets").mapInArrow(run, "range int, prints binary, counts binary")
    return rows.repartition("range").sortWithinPartitions("range").mapInArrow(add_up, "print long, f long")


def bit_table(prints: DataFrame) -> np.ndarray:
    """The fixed-size table of the fingerprints' low bits, put together by Spark in words of 64 bits."""
    slot = F.col("print").bitwiseAND(F.lit(FILTER_BITS - 1).cast("long"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
    rows = prints.select(F.shiftright(slot, 6).alias("at"), bit.alias("bit"))
    found = rows.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    table[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return table


def phrase_counts(cut: DataFrame, tables: list, least: int, words: int) -> DataFrame:
    """``lang, phrase, words, f`` of all phrases found ``least`` times or more, counted by their text.

    A block sends its phrases, cut out of the text, in ranges of their fingerprints; counts are added up by
    language, length and text.
    """
    bits = max((words // RANGE).bit_length(), RANGE_BITS)
    names = ["range", "lang", "words", "phrases", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
        for batch in batches:
            for runs in all_runs(batch):
                for k, table in enumerate(tables, 1):
                    for prints, place, count in runs.phrases(k, table.value):
                        at = np.append(np.searchsorted(prints, edges), len(prints))
                        full = np.flatnonzero(at[1:] > at[:-1])
                        texts = [runs.text(x, k) for x in place.tolist()]
                        # no word holds a line end
                        packed = [b"\n".join(texts[at[r]:at[r + 1]]) for r in full.tolist()]
                        yield pa.RecordBatch.from_arrays([
                            pa.array(full.astype(np.int32)), pa.array([runs.lang] * len(full), pa.string()), pa.array([k] * len(full), pa.int32()),
                            pa.array(packed, pa.binary()), _binary(count.astype(np.int32), np.append(at[full], len(prints)))], names)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, defaultdict(int)

        def frequent() -> pa.RecordBatch:
            many = {p.decode("utf-8", "replace"): f for p, f in total.items() if f >= least}
            lang, k = (now[1], now[2]) if now else ("", 0)
            return pa.RecordBatch.from_arrays([
                pa.array([lang] * len(many), pa.string()), pa.array(list(many), pa.string()),
                pa.array([k] * len(many), pa.int32()), pa.array(list(many.values()), pa.int64())], ["lang", "phrase", "words", "f"])

        for batch in batches:
            for i in range(batch.num_rows):
                here = tuple(batch.column(j)[i].as_py() for j in range(3))
                if here != now:
                    yield frequent()
                    now, total = here, defaultdict(int)
                counts = np.frombuffer(batch.column(4)[i].as_buffer(), np.int32).tolist()
                for phrase, f in zip(batch.column(3)[i].as_py().split(b"\n"), counts, strict=True):
                    total[phrase] += f
        yield frequent()

    rows = cut.select("lang", "codes", "words", "offsets").mapInArrow(run, "range int, lang string, words int, phrases binary, counts binary")
    return rows.repartition("range").sortWithinPartitions("range", "lang", "words").mapInArrow(add_up, "lang string, phrase string, words int, f long")


def _part(phrase: Column, first: Column, n: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " ", -1), first, n), " ")


def scores(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """``lang, phrase, words, a, l, r, n, score`` of every phrase of two or more words, by its worst cut.

    ``score = floor(1000 a n / (l r))`` in exact decimal arithmetic; among equal scores the shortest
    first part counts.
    """
    whole = counts.filter("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    cuts = whole.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumns({"left": _part(F.col("phrase"), F.lit(1), F.col("cut")),
                             "right": _part(F.col("phrase"), F.col("cut") + 1, F.col("words") - F.col("cut"))})
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    cuts = cuts.join(F.broadcast(sizes), "lang")
    score = F.expr("cast(a as decimal(15,0)) * (cast(n as decimal(17,0)) * 1000) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    cuts = cuts.withColumn("score", score)
    worst = cuts.groupBy("lang", "phrase", "words", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))
    return worst.select("lang", "phrase", "words", "a", "low.l", "low.r", "n", "low.score")


def uncontained(scored: DataFrame) -> DataFrame:
    """Without the phrases that a longer one contains as often as they are found at all.

    The counts of a phrase and of the longer ones around it only fall, so it is enough to look at
    phrases that are longer by one word.
    """
    inner = F.array(_part(F.col("phrase"), F.lit(1), F.col("words") - 1), _part(F.col("phrase"), F.lit(2), F.col("words") - 1))
    longer = scored.filter("words > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("around"))
    most = longer.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    return scored.join(most, ["lang", "phrase"], "left").filter(F.col("around").isNull() | (F.col("around") < F.col("a"))).drop("around")


def first_of_each(rows: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` best of each language; parts of a language are ranked first, then their best together."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    best = rows.withColumn("place", F.row_number().over(part)).filter(F.col("place") <= limit).drop("place")
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= limit)


def collocations(docs: DataFrame, longest: int = 5, least: int = 100, limit: int = 2000) -> DataFrame:
    """Each language's best phrases of 2 to ``longest`` words found ``least`` times or more.

    Returns ``lang, rank, phrase, a, l, r, n, score``.  A NULL text is empty, a NULL lang is
    ``und`` and shares its counts; rows are counted as often as they stand in ``docs``, ids are not looked
    at.  Phrases do not cross pieces or texts; very long texts are one block of their own.  Equal scores
    are ordered by count, then by the phrase's UTF-8 bytes.  An empty table gives no rows.  Columns other
    than ``text`` and ``lang`` may have any name.
    """
    spark = docs.sparkSession
    cut = stored(word_blocks(docs), "phrase-blocks")
    sizes = cut.groupBy("lang").agg(F.sum("n").alias("n"))
    words = sizes.agg(F.sum("n")).first()[0] or 0
    tables, before = [], None
    for k in range(1, longest + 1):
        prints = stored(frequent_prints(cut, k, least, before, words), f"phrase-prints-{k}")
        before = spark.sparkContext.broadcast(bit_table(prints))
        tables.append(before)
    counts = stored(phrase_counts(cut, tables, least, words), "phrases")
    best = first_of_each(uncontained(scores(counts, sizes)), limit)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
