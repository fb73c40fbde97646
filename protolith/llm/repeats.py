"""Repeated passages: a depth-limited radix sort of sampled suffixes.

Two equal strings of ``length`` bytes hold the same smallest ``DIGIT``-byte gram (by hash, the
leftmost one) at the same place.  So only suffixes that begin at such an anchor are sorted,
about one in 33, and each stands for the run of starts whose strings chose it.  The sort goes
by most significant digit and stops at the threshold:

Runs that repeat inside their own text are settled on the spot and stay out of the sort.

1. first digit: the anchor's gram.  A gram that occurs once leaves the sort;
2. second digit: all bytes that the strings of a run cover.  Runs equal in it are equal in every
   string; all but the first are repeats;
3. where one gram stands in different runs, the strings of each distinct run are taken in parts of
   ``PART`` starts.  Third digit: the bytes that all strings of a part share.  A part that is alone
   with it leaves the sort, and parts that cover the same bytes are settled as in 2;
4. the strings of parts still open are told apart one by one.

A pass is a count per digit, pre-aggregated before the shuffle, and a join back; a digit held
by a third of all texts is folded map-side on one side and split by the skew join on the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from protolith.session import cut_lineage

from .textkit import BLOCK_BYTES, LAST_ID, Rolling, blocks, mix, ranges, release

DIGIT = 36
PART = 16
_POSITION = np.uint64((1 << 26) - 1)
_PIECE = 1 << 24


class Anchors(NamedTuple):
    gram: np.ndarray     # first digit
    run: np.ndarray      # second digit
    place: np.ndarray    # start of the anchor's gram
    first: np.ndarray    # first start of a string that chose the anchor
    last: np.ndarray     # last one
    windows: Rolling


def anchors(data: np.ndarray, start: np.ndarray, length: int) -> Anchors:
    """Anchors of all strings of ``length`` bytes inside the texts of a block."""
    grams = min(DIGIT, length)
    span = length - grams + 1
    rolling = Rolling(data)
    n = len(data) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return Anchors(none.astype(np.uint64), none.astype(np.uint64), none, none, none, rolling)
    hashes = rolling.grams(grams)
    low = (hashes & ~_POSITION) | np.arange(len(hashes), dtype=np.uint64)
    reach = 1
    while 2 * reach <= span:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if span > reach:
        low = np.minimum(low[:reach - span], low[span - reach:])
    place = (low & _POSITION).astype(np.int64)
    inside = np.ones(n + 1, dtype=bool)
    inside[n] = False
    for lo, hi in zip(start[:-1].tolist(), start[1:].tolist()):
        inside[max(lo, hi - length + 1):hi] = False
    opens = inside[:-1].copy()
    opens[1:] &= (place[1:] != place[:-1]) | ~inside[:-2]
    shuts = inside[:-1].copy()
    shuts[:-1] &= (place[1:] != place[:-1]) | ~inside[1:-1]
    first, last = np.flatnonzero(opens), np.flatnonzero(shuts)
    place = place[first]
    shape = (place - first).astype(np.uint64) * np.uint64(1 << 20) + (last - first).astype(np.uint64)
    run = mix(rolling.at(first, last + length) ^ mix(shape + np.uint64(1)))
    return Anchors(hashes[place], run, place, first, last, rolling)


def _pieces(data: np.ndarray, start: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """A block as it is, or a very long text as overlapping pieces: offset, bytes, text bounds."""
    if len(data) <= _PIECE:
        yield 0, data, start
        return
    for at in range(0, len(data), _PIECE):
        piece = data[at:at + _PIECE + length - 1]
        yield at, piece, np.clip(start - at, 0, len(piece))


def _block_anchors(block, length: int) -> Iterator[tuple[Anchors, np.ndarray, int]]:
    """Anchors of a block, the text of each, and the offset to add to positions."""
    for at, data, start in _pieces(block.data, block.start, length):
        found = anchors(data, start, length)
        yield found, np.searchsorted(start, found.place, "right") - 1, at


def _first_in_text(found: Anchors, text: np.ndarray) -> np.ndarray:
    """Whether a run is the first of its kind in its own text; later ones are repeats without any sort."""
    order = np.lexsort((found.place, found.run, found.gram, text))
    a, b = order[1:], order[:-1]
    out = np.ones(len(text), dtype=bool)
    out[a] = (text[a] != text[b]) | (found.gram[a] != found.gram[b]) | (found.run[a] != found.run[b])
    return out


def gram_counts(docs: DataFrame, length: int) -> DataFrame:
    """``gram, n``: how often each first digit occurs, already summed per block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(0)):
                for found, text, _ in _block_anchors(block, length):
                    gram, n = np.unique(found.gram[_first_in_text(found, text)], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(np.minimum(n, 2).astype(np.int32))], ["gram", "n"])

    return docs.select("text").mapInArrow(run, "gram long, n int")


def suffixes(docs: DataFrame, length: int) -> DataFrame:
    """``gram, run, id, key, place`` of every anchor that is the first of its kind in its text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for block in blocks(batch.column(2)):
                for found, text, at in _block_anchors(block, length):
                    new = _first_in_text(found, text)
                    text = text[new]
                    place = found.place[new] + at - block.start[text]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found.gram[new].view(np.int64)), pa.array(found.run[new].view(np.int64)),
                         pa.array(ids[block.rows][text]), pa.array(keys[block.rows][text]), pa.array(place)], ["gram", "run", "id", "key", "place"])

    return docs.select("id", "key", "text").mapInArrow(run, "gram long, run long, id long, key long, place long")


def open_bytes(marked: DataFrame, length: int) -> DataFrame:
    """``gram, id, key, place, first, last, bytes`` of the runs whose anchors are in ``places``: the distances of
    the anchor from the first and last string's start, and all bytes that the strings cover."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for block in blocks(batch.column(2)):
                places, row = _flat(batch.column(3)[block.rows])
                wanted = np.unique(block.start[row] + places)
                for found, text, at in _block_anchors(block, length):
                    hit = np.flatnonzero(np.isin(found.place + at, wanted))
                    lo, hi = found.first[hit] + at, found.last[hit] + at + length
                    place = found.place[hit] + at
                    doc = text[hit]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found.gram[hit].view(np.int64)), pa.array(ids[block.rows][doc]), pa.array(keys[block.rows][doc]),
                         pa.array(place - block.start[doc]),
                         pa.array((place - lo).astype(np.int32)), pa.array((place - (hi - length)).astype(np.int32)),
                         pa.array([block.data[a:b].tobytes() for a, b in zip(lo.tolist(), hi.tolist())], pa.binary())],
                        ["gram", "id", "key", "place", "first", "last", "bytes"])

    return marked.select("id", "key", "text", "places").mapInArrow(run, "gram long, id long, key long, place long, first int, last int, bytes binary")


class Hulls(NamedTuple):
    """Bytes of many runs end to end."""
    rolling: Rolling
    begin: np.ndarray
    first: np.ndarray    # distance of the anchor from the first string's start
    last: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch, first: int, last: int, data: int) -> Hulls:
        column = batch.column(data)
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
        raw = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]] if len(column) else np.zeros(0, np.uint8)
        return cls(Rolling(raw), offsets[:-1] - offsets[0], batch.column(first).to_numpy().astype(np.int64), batch.column(last).to_numpy().astype(np.int64))


def parts_of(opened: DataFrame, length: int) -> DataFrame:
    """``gram, part, core, hull, id, key, place, start, n``: the parts of the runs in ``opened`` with their digits."""
    names = ["gram", "part", "core", "hull", "id", "key", "place", "start", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            hulls = Hulls.of(batch, 4, 5, 6)
            low, high = hulls.last // PART, hulls.first // PART
            row = np.repeat(np.arange(batch.num_rows), high - low + 1)
            part = ranges(low, high - low + 1)
            anchor = hulls.begin[row] + hulls.first[row]
            near, far = np.maximum(part * PART, hulls.last[row]), np.minimum(part * PART + PART - 1, hulls.first[row])
            # shared by every string of the whole part, whichever of its starts this run has
            core = hulls.rolling.at(anchor - part * PART, anchor - (part * PART + PART - 1) + length)
            hull = hulls.rolling.at(anchor - far, anchor - near + length) ^ mix((far * 65536 + near).astype(np.uint64) + np.uint64(1))
            place = batch.column(3).to_numpy()[row]
            start = place - far
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(part), pa.array(core.view(np.int64)), pa.array(hull.view(np.int64)),
                 batch.column(1).take(pa.array(row)), batch.column(2).take(pa.array(row)), pa.array(place), pa.array(start), pa.array(far - near + 1)], names)

    return opened.select("gram", "id", "key", "place", "first", "last", "bytes").mapInArrow(run, ", ".join(f"{c} long" for c in names))


def single_strings(opened: DataFrame, length: int) -> DataFrame:
    """``gram, string, id, key, start`` of every string of the parts in ``parts``; one digit per string."""
    names = ["gram", "string", "id", "key", "start"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            hulls = Hulls.of(batch, 4, 5, 6)
            part, row = _flat(batch.column(7))
            near, far = np.maximum(part * PART, hulls.last[row]), np.minimum(part * PART + PART - 1, hulls.first[row])
            back, row = ranges(near, far - near + 1), np.repeat(row, far - near + 1)
            begin = hulls.begin[row] + hulls.first[row] - back
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(hulls.rolling.at(begin, begin + length).view(np.int64)),
                 batch.column(1).take(pa.array(row)), batch.column(2).take(pa.array(row)), pa.array(batch.column(3).to_numpy()[row] - back)], names)

    return opened.select("gram", "id", "key", "place", "first", "last", "bytes", "parts").mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column end to end, and the row of each."""
    many = lists.value_lengths().fill_null(0).to_numpy()
    values = lists.flatten().to_numpy()
    return values, np.repeat(np.arange(len(many)), many)


def _flat_pairs(lists: pa.Array) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """The two fields of a column of lists of pairs end to end, and the row of each."""
    many = lists.value_lengths().fill_null(0).to_numpy()
    a, b = lists.flatten().flatten()
    return (a.to_numpy(), b.to_numpy()), np.repeat(np.arange(len(many)), many)


def spans(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals as maximal ones."""
    if not len(starts):
        return starts, stops
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    new = np.ones(len(starts), dtype=bool)
    new[1:] = starts[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return starts[at], reach[np.append(at[1:], len(starts)) - 1]


def _id(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST_ID))


def repeated_places(docs: DataFrame, length: int) -> DataFrame:
    """``id, key, runs, strings``, one row for each distinct text of an id: places of the anchors whose strings all start earlier elsewhere, and
    ``(start, n)`` of further neighbouring strings that do.  Texts without any are left out."""
    spark = docs.sparkSession
    texts = docs.select(_id().alias("id"), F.xxhash64("text").alias("key"), "text")
    again = gram_counts(texts, length).groupBy("gram").agg(F.sum("n").alias("n")).filter("n > 1").select("gram")
    kept = cut_lineage(suffixes(texts, length).join(again, "gram"))
    del again
    release(spark)
    runs = kept.groupBy("gram", "run").agg(F.min(F.struct("id", "place", "key")).alias("first"))
    kinds = runs.groupBy("gram").agg((F.count(F.lit(1)) > 1).alias("ragged"))
    runs = runs.join(kinds, "gram")
    told = kept.join(runs, ["gram", "run"]).select("id", "key", "place", "ragged", (F.struct("id", "place", "key") != F.col("first")).alias("later"))
    told = cut_lineage(told.filter("later or ragged"))
    del kept, runs, kinds
    release(spark)
    open_runs = told.filter("not later").groupBy("id", "key").agg(F.collect_set("place").alias("places"))
    opened = cut_lineage(open_bytes(texts.join(open_runs, ["id", "key"]), length))
    del open_runs
    release(spark)
    parts = parts_of(opened, length)
    digits = parts.groupBy("gram", "part", "core").agg(
        F.min(F.struct("id", "start", "key")).alias("first"), (F.min("hull") != F.max("hull")).alias("ragged"), F.count(F.lit(1)).alias("members"))
    late = parts.join(digits.filter("members > 1"), ["gram", "part", "core"]).filter(F.col("ragged") | (F.struct("id", "start", "key") != F.col("first")))
    late = cut_lineage(late.select("id", "key", "place", "part", "start", "n", "ragged"))
    wanted = late.filter("ragged").groupBy("id", "key", "place").agg(F.collect_set("part").alias("parts"))
    strings = cut_lineage(single_strings(opened.join(wanted, ["id", "key", "place"]), length))
    firsts = strings.groupBy("gram", "string").agg(F.min(F.struct("id", "start", "key")).alias("first"), F.count(F.lit(1)).alias("members"))
    single = strings.join(firsts.filter("members > 1"), ["gram", "string"]).filter(F.struct("id", "start", "key") != F.col("first"))
    none = F.lit(None).cast("long")
    marks = told.filter("later").select("id", "key", "place", none.alias("start"), none.alias("n")).union(
        late.filter("not ragged").select("id", "key", none, "start", "n")).union(single.select("id", "key", none, "start", F.lit(1).cast("long")))
    out = cut_lineage(marks.groupBy("id", "key").agg(
        F.collect_set("place").alias("runs"), F.collect_set(F.when(F.col("n").isNotNull(), F.struct("start", "n"))).alias("strings")))
    del told, opened, parts, digits, late, wanted, strings, firsts, single, marks
    release(spark)
    return out


def remove_repeats(docs: DataFrame, length: int = 100, extra: list[str] | None = None, with_text: bool = False) -> DataFrame:
    """Remove every byte covered by a string of ``length`` bytes that also starts earlier.

    Texts are UTF-8 bytes, NULL is empty.  Earlier means in a smaller doc_id, or in the same text
    further left; a missing doc_id sorts behind all others.  Matches never cross texts and
    strings are judged on the input.  One row for each row of ``docs``: ``doc_id, n_bytes,
    n_removed, n_spans, kept_sha256``.  Rows repeated in full are one text and have equal results;
    different texts under one doc_id are ordered by position, then by a digest.  ``with_text`` adds
    ``text``: what is left, where a character that lost a byte goes as a whole.  Columns named in
    ``extra`` are passed through.
    """
    extra = extra or []
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    given = [docs[c].alias(f"x{i}") for i, c in enumerate(extra)]
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"], *given).withColumn("id", _id()).withColumn("key", F.xxhash64("text"))
    marks = repeated_places(docs, length)
    rows = rows.join(marks, ["id", "key"], "left").select("doc_id", "text", "runs", "strings", *(f"x{i}" for i in range(len(extra))))
    schema = [f"`{c}` {kinds[c]}" for c in extra] + ["doc_id long", "n_bytes long", "n_removed long", "n_spans long", "kept_sha256 string"]
    names = [*extra, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["text"] * with_text
    schema += ["text string"] * with_text

    def cut(block, batch: pa.RecordBatch) -> Iterator[tuple]:
        runs, run_row = _flat(batch.column(2)[block.rows])
        (single, many), row = _flat_pairs(batch.column(3)[block.rows])
        wanted = np.unique(block.start[run_row] + runs)
        starts = block.start[row] + single
        begins, ends = [starts], [starts + many - 1 + length]
        for found, text, at in _block_anchors(block, length):
            late = ~_first_in_text(found, text)
            if len(wanted):
                late |= np.isin(found.place + at, wanted)
            begins.append(found.first[late] + at)
            ends.append(found.last[late] + at + length)
        begin, end = np.concatenate(begins), np.concatenate(ends)
        owner = np.searchsorted(block.start, begin, "right") - 1
        order = np.argsort(owner, kind="stable")
        begin, end, at = begin[order], end[order], np.searchsorted(owner[order], np.arange(len(block.start)))
        for i in range(len(block.start) - 1):
            lo, hi = spans(begin[at[i]:at[i + 1]], end[at[i]:at[i + 1]])
            text = block.data[block.start[i]:block.start[i + 1]]
            left = text
            if len(lo):
                cover = np.zeros(len(text) + 1, dtype=np.int8)
                cover[lo - block.start[i]] = 1
                cover[hi - block.start[i]] -= 1
                gone = np.cumsum(cover[:-1]).astype(bool)
                left = text[~gone]
            removed = len(text) - len(left)
            row = (len(text), removed, len(lo), hashlib.sha256(left.tobytes()).hexdigest())
            if with_text:
                if removed:
                    char = np.cumsum((text & 0xC0) != 0x80) - 1
                    broken = np.zeros(int(char[-1]) + 1, dtype=bool)
                    broken[char[gone]] = True
                    left = text[~broken[char]]
                row += (left.tobytes().decode("utf-8", "replace"),)
            yield row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 3 + [pa.string()] * (1 + with_text)
        for batch in batches:
            for block in blocks(batch.column(1)):
                made = [pa.array(column, kind) for column, kind in zip(zip(*cut(block, batch)), types)]
                passed = [batch.column(4 + i)[block.rows] for i in range(len(extra))]
                yield pa.RecordBatch.from_arrays([*passed, batch.column(0)[block.rows], *made], names)

    return rows.mapInArrow(run, ", ".join(schema))
