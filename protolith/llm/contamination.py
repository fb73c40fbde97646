"""Benchmark decontamination: greedy string tiling between documents and benchmark items.

Seeds are runs of ``TILE`` words.  A fixed-size bit table of the benchmark's seeds thins the
documents to the stretches that can lie in a tile; seeds of those are joined with the
benchmark's seeds, and each (document, item) pair that shares enough of them is tiled: the
longest common runs of unmarked words are found by running Karp-Rabin hashes, marked, and
the search goes on with shorter ones.  Reordered passages still cover the item.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from protolith.session import cut_lineage

from .textkit import LAST_ID, blocks, ranges, window_hashes
from .wordblocks import word_hashes

TILE = 5
COVERAGE = 0.5
#: Bits of the seed table; its size is fixed, whatever the benchmark holds.
TABLE_BITS = 22


def _separators() -> np.ndarray:
    """ASCII bytes that are neither letters nor digits part words."""
    out = np.zeros(256, dtype=bool)
    out[:128] = True
    out[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
    return out


def block_words(block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a block (A-Z lower-cased, punctuation left out), and the bounds of its texts."""
    words, _, _, owner = word_hashes(block, _separators())
    return words, np.searchsorted(owner, np.arange(len(block.start)))


def tile(item: list[int], doc: list[int], least: int) -> np.ndarray:
    """Greedy string tiling; which words of ``item`` lie in a tile of at least ``least`` words."""
    in_item, in_doc = [False] * len(item), [False] * len(doc)
    search = max(least, min(32, len(item)))

    def windows(words: list[int], marked: list[bool], k: int) -> dict[int, list[int]]:
        """Starts of unmarked windows by running hash."""
        found = defaultdict(list)
        base, mod = 1_000_003, (1 << 61) - 1
        top, value, clear = pow(base, k - 1, mod), 0, 0
        for i, word in enumerate(words):
            if marked[i]:
                value = clear = 0
                continue
            if clear >= k:
                value = (value - words[i - k] * top) % mod
            value = (value * base + word) % mod
            clear += 1
            if clear >= k:
                found[value].append(i - k + 1)
        return found

    while True:
        there = windows(doc, in_doc, search)
        matches = []
        for value, starts in windows(item, in_item, search).items():
            for i in starts:
                for j in there.get(value, ()):
                    if i and j and not in_item[i - 1] and not in_doc[j - 1] and item[i - 1] == doc[j - 1]:
                        continue  # not the left end of the match
                    n = 0
                    while i + n < len(item) and j + n < len(doc) and not in_item[i + n] and not in_doc[j + n] \
                            and item[i + n] == doc[j + n]:
                        n += 1
                    if n >= search:
                        matches.append((n, i, j))
        longest = max((m[0] for m in matches), default=0)
        if longest > 2 * search:
            search = longest
            continue
        left_over = False
        for n, i, j in sorted(matches, key=lambda m: (-m[0], m[1], m[2])):
            if not any(in_item[i:i + n]) and not any(in_doc[j:j + n]):
                in_item[i:i + n] = [True] * n
                in_doc[j:j + n] = [True] * n
            else:
                left_over = True
        if left_over and matches:
            continue
        if search == least:
            return np.array(in_item)
        search = max(least, search // 2)


def item_words(texts: DataFrame) -> DataFrame:
    """``item_key, words`` (hashes) of every row of ``item_key, text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                words, at = block_words(block)
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(words.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0)[block.rows], lists], ["item_key", "words"])

    return texts.select("item_key", "text").mapInArrow(run, "item_key long, words array<long>")


def _seeds(words: DataFrame) -> DataFrame:
    """``item_key, n_words, seed, places``: each seed with the number of its places; items with fewer words than a tile have none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, row in zip(batch.column(0).to_pylist(), batch.column(1)):
                hashes = np.array(row.as_py(), dtype=np.int64).view(np.uint64)
                seeds, places = np.unique(window_hashes(hashes, TILE), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(seeds), pa.int64()), pa.array([len(hashes)] * len(seeds), pa.int64()),
                     pa.array(seeds.view(np.int64)), pa.array(places.astype(np.int64))],
                    ["item_key", "n_words", "seed", "places"])

    return words.mapInArrow(run, "item_key long, n_words long, seed long, places long")


def seed_table(seeds: DataFrame) -> np.ndarray:
    """Bit table of the benchmark's seeds; at most 2 ** TABLE_BITS slot numbers reach the driver."""
    slots = seeds.select(F.shiftrightunsigned("seed", 64 - TABLE_BITS).alias("slot")).distinct()
    held = np.zeros(1 << TABLE_BITS, dtype=bool)
    held[slots.toArrow().column(0).to_numpy()] = True
    return np.packbits(held)


def stretches(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """``id, text_key, at, words, seeds``: the runs of words of each text whose seeds may be in the table, by first word."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            for block in blocks(batch.column(2)):
                words, at = block_words(block)
                seeds = window_hashes(words, TILE)
                hit = held[(seeds >> np.uint64(64 - TABLE_BITS)).astype(np.int64)]
                for hi in at[1:-1].tolist():  # seeds do not cross texts
                    hit[max(0, hi - TILE + 1):hi] = False
                at_hit = np.flatnonzero(hit)
                if not len(at_hit):
                    continue
                text = np.searchsorted(at, at_hit, "right") - 1
                new = np.ones(len(at_hit), dtype=bool)
                new[1:] = (at_hit[1:] != at_hit[:-1] + 1) | (text[1:] != text[:-1])
                first = np.flatnonzero(new)
                many = np.diff(np.append(first, len(at_hit)))
                spread = ranges(at_hit[first], many + TILE - 1)
                rows = pa.array(text[first])
                offsets = lambda n: pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[block.rows].take(rows), batch.column(1)[block.rows].take(rows),
                    pa.array(at_hit[first] - at[text[first]]),
                    pa.ListArray.from_arrays(offsets(many + TILE - 1), pa.array(words[spread].view(np.int64))),
                    pa.ListArray.from_arrays(offsets(many), pa.array(seeds[at_hit].view(np.int64)))],
                    ["id", "text_key", "at", "words", "seeds"])

    return docs.mapInArrow(run, "id long, text_key long, at long, words array<long>, seeds array<long>")


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Pairs of documents and benchmark items they hold: ``doc_id, item_id, coverage, tiled_words,
    item_words, contaminated, text_key``.

    A pair is reported when tiles of at least ``TILE`` words cover ``coverage`` of the item's words.
    NULL texts and texts without words match nothing, nor do items with fewer words than a tile.
    Rows repeated in full give one pair; different texts under one id are judged apart
    (``text_key`` is ``xxhash64(text)``).  So are the texts of an item_id, of which the best covered
    one is reported.  A missing doc_id or item_id is reported as NULL; every text without item_id is
    an item of its own.
    """
    named = cut_lineage(benchmark.select("item_id", F.xxhash64("text").alias("item_key"), "text").filter("text IS NOT NULL").distinct())
    items = cut_lineage(item_words(named.dropDuplicates(["item_key"])))
    seeds = cut_lineage(_seeds(items))
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"), F.xxhash64("text").alias("text_key"), "text")
    found = cut_lineage(stretches(keyed, seed_table(seeds)))

    met = found.select("id", "text_key", F.explode("seeds").alias("seed")).distinct().join(seeds, "seed")
    enough = met.groupBy("id", "text_key", "item_key").agg(F.sum("places").alias("shared"), F.first("n_words").alias("n"))
    # tiles of TILE words need at least one place of a seed for every TILE words they cover
    pairs = enough.filter(F.col("shared") * TILE >= coverage * F.col("n")).select("id", "text_key", "item_key")
    runs = found.join(pairs.select("id", "text_key").distinct(), ["id", "text_key"], "left_semi").groupBy("id", "text_key").agg(
        F.collect_set(F.struct("at", "words")).alias("runs"))
    ready = pairs.join(items, "item_key").join(runs, ["id", "text_key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                doc: list[int] = []
                for i, stretch in enumerate(sorted(row["runs"], key=lambda r: r["at"])):
                    doc += [*(w & 0xFFFFFFFFFFFFFFFF for w in stretch["words"]), (1 << 64) + i]  # a word of its own between stretches
                item = [w & 0xFFFFFFFFFFFFFFFF for w in row["words"]]
                covered = int(tile(item, doc, TILE).sum())
                if covered >= coverage * len(item):
                    made.append((row["id"], row["text_key"], row["item_key"], covered / len(item), covered, len(item)))
            kinds = [pa.int64()] * 3 + [pa.float64()] + [pa.int64()] * 2
            columns = zip(*made) if made else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["id", "text_key", "item_key", "coverage", "tiled_words", "item_words"])

    held = ready.select("id", "text_key", "item_key", "words", "runs").mapInArrow(
        run, "id long, text_key long, item_key long, coverage double, tiled_words long, item_words long")
    nameless = F.when(F.col("item_id").isNull(), F.col("item_key")).alias("nameless")
    best = held.join(named.select("item_id", "item_key"), "item_key").groupBy("id", "text_key", "item_id", nameless).agg(
        F.max(F.struct("coverage", "tiled_words", "item_words")).alias("best"))
    return best.select(F.when(F.col("id") != LAST_ID, F.col("id")).alias("doc_id"), F.col("item_id").cast("long").alias("item_id"),
                       "best.coverage", "best.tiled_words", "best.item_words", F.lit(True).alias("contaminated"), "text_key")
