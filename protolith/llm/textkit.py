"""Shared helpers: texts as byte arrays, rolling hashes, folds, bounded samples, housekeeping.

A block is a run of texts laid end to end in one ``uint8`` array.  Everything that
looks at single bytes or words works on a whole block at once, so that the cost per
byte is a few array passes and memory is bounded by the block, not by the task.
"""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 2_000_000
#: An id that sorts behind all others stands for a missing one.
LAST_ID = (1 << 63) - 1
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


class Block(NamedTuple):
    rows: slice          # of the Arrow batch
    data: np.ndarray     # uint8, all texts end to end
    start: np.ndarray    # int64, len(rows) + 1 offsets into data

    def text(self, i: int) -> bytes:
        return self.data[self.start[i]:self.start[i + 1]].tobytes()


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a string column into blocks of about ``limit`` bytes; a longer text is a block of its own."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield Block(slice(lo, hi), data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        lo = hi


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h *= _MIX1
    h ^= h >> np.uint64(27)
    h *= _MIX2
    h ^= h >> np.uint64(31)
    return h


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        base = _BASE if kind == "up" else _BASE_INVERSE
        steps = np.full(max(n, BLOCK_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if n <= 8 * BLOCK_BYTES:
            _powers[kind] = have
    return have[:n]


class Rolling:
    """Hashes of any substrings of one byte array, each in constant time."""

    def __init__(self, data: np.ndarray, code: np.ndarray = _BYTE_CODE):
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(code[data] * _power("up", len(data)), out=self.sums[1:])

    def at(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * _power("down", len(self.sums))[start])

    def grams(self, k: int) -> np.ndarray:
        """Of all substrings of ``k`` bytes, by start."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[k:] - self.sums[:-k]) * _power("down", n))


def lower_code() -> np.ndarray:
    """Byte codes under which A-Z equal a-z."""
    code = _BYTE_CODE.copy()
    code[65:91] = code[97:123]
    return code


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True


def word_spans(block: Block, separators: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, stop and text number of every word of a block, by default ``[^\\x20\\x09-\\x0D]+``."""
    if not len(block.data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = ~separators[block.data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = block.start[1:-1]
    edges = edges[edges < len(inside)]
    first[edges] = inside[edges]
    start = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = edges[edges > 0] - 1
    last[ends] = inside[ends]
    stop = np.flatnonzero(last) + 1
    owner = np.searchsorted(block.start, start, "right") - 1
    return start, stop, owner


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every ``k`` neighbouring word hashes, by first word."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        out *= np.uint64(_BASE)
        out += words[i:i + n]
    return mix(out)


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers of all ranges ``start .. start + length - 1``, end to end."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(length) - length
    return np.repeat(start - before, length) + np.arange(total)


def fold(doc_id: Column | str) -> Column:
    """crc32 of the id as text, modulo 4; NULL for a missing id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string")) % 4


def held_out(doc_id: Column | str) -> Column:
    return F.coalesce(fold(doc_id) == 2, F.lit(False))


def may_learn(doc_id: Column | str) -> Column:
    return F.coalesce(fold(doc_id) != 2, F.lit(False))


def sample_ids(labels: DataFrame, label: str, rows: int) -> DataFrame:
    """A bounded sample of labelled ids that may be learned from: at most ``rows``, lowest hash first.

    An id with several labels takes the smallest.  The result is small enough to broadcast.
    """
    known = (labels.select("doc_id", F.col(label).cast("int").alias("label"))
             .filter(may_learn("doc_id") & F.col("label").isin(0, 1)))
    return (known.groupBy("doc_id").agg(F.min("label").alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of frames that are no longer referenced.

    Python hands its dropped references to the JVM a little later, and the listener queue holds on to
    the last finished query until another event follows: hence the pause and the one-row job.
    """
    gc.collect()
    time.sleep(1.0)
    spark.range(1).count()
    time.sleep(0.2)
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
