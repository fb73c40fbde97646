"""Near-duplicates: b-bit MinHash signatures and a multi-index Hamming join.

The indexed part of a signature has ``SYMBOLS`` MinHash values of 16 bits; its distance counts the
values that differ.  It is split into ``CHUNKS`` chunks.  Two signatures at a distance of at most
``REACH = 2 * CHUNKS - 1`` differ in at most one value of some chunk, so the keys "chunk without
one value", all of which are enumerated, bring every such pair into one bucket.  A pair at
similarity 0.8 differs in 12.8 of 64 values on average (standard deviation 3.2), so REACH lies more
than five deviations above.  ``MORE`` further values of 8 bits sharpen the distance before any set
is read; their limit lies five deviations above as well.

Texts with the same set are one class and meet no join as copies.  Links between classes are found
in two ways, and all are confirmed on the full sets:

1. in rounds each class meets one class of its buckets, and links merge components.  First that is the most
   popular one, whose buckets hold the most classes: in a group of near copies that is the text they
   were made from.  Later rounds draw another one each, among the buckets that still hold several
   components, while that merges more than a few;
2. buckets that still hold several components are joined into families, by their most popular class, so
   that a class is in a family once, however many buckets it shares.  Members of different
   components are compared in cells of at most ``2 * CELL``, on signatures and then on full sets.  A cell
   passes on only links that merge something.

Members of one component need no further pair, so a group of thousands of near copies costs a few
pairs for each member, and no link between components is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from protolith.session import cut_lineage

from .components import components
from .textkit import LAST_ID, blocks, mix, release, window_hashes
from .wordblocks import byte_set, word_hashes

SYMBOLS, WIDTH = 64, 4
CHUNKS = SYMBOLS // WIDTH
REACH = 2 * CHUNKS - 1
MORE = 192
#: Of all values; 0.2 of them differ on average at similarity 0.8.
FAR = int(0.2 * (SYMBOLS + MORE) + 5 * (0.16 * (SYMBOLS + MORE)) ** 0.5)
CELL = 2048
#: Rounds end when they merge fewer than one in SLOW of the classes that are open.
SLOW = 50
PART = 2048
SPACES = byte_set(32, *range(9, 14))

_ODD = mix(np.arange(1, SYMBOLS + MORE + 1, dtype=np.uint64)).astype(np.uint32) | np.uint32(1)
_ADD = mix(np.arange(1001, SYMBOLS + MORE + 1001, dtype=np.uint64)).astype(np.uint32)


def shingle_sets(column: pa.Array, words: int) -> Iterator[tuple[slice, list[np.ndarray]]]:
    """Sorted distinct shingle hashes of every text, block by block.

    A text with fewer words has its whole sequence as one shingle; one without words has none.
    """
    for block in blocks(column):
        hashes, _, _, owner = word_hashes(block, SPACES)
        grams = window_hashes(hashes, words)
        n = len(block.start) - 1
        first = np.searchsorted(owner, np.arange(n + 1))
        sets = []
        for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
            if hi - lo >= words:
                sets.append(np.unique(grams[lo:hi - words + 1]))
            elif hi > lo:
                sets.append(window_hashes(hashes[lo:hi], hi - lo) ^ np.uint64(hi - lo))
            else:
                sets.append(np.zeros(0, np.uint64))
        yield block.rows, sets


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signature(shingles: np.ndarray) -> bytes:
    """MinHash values of a set: SYMBOLS of 16 bits, then MORE of 8 bits."""
    low = np.full(SYMBOLS + MORE, 0xFFFFFFFF, dtype=np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), PART):
        low = np.minimum(low, (short[None, at:at + PART] * _ODD[:, None] + _ADD[:, None]).min(axis=1))
    values = mix(low.astype(np.uint64))
    return (values[:SYMBOLS] >> np.uint64(48)).astype(np.uint16).tobytes() + (values[SYMBOLS:] >> np.uint64(56)).astype(np.uint8).tobytes()


def read_signatures(stored: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(stored), dtype=np.uint8).reshape(len(stored), -1)
    return np.ascontiguousarray(raw[:, :2 * SYMBOLS]).view(np.uint16), raw[:, 2 * SYMBOLS:]


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """For each signature the keys of its chunks without one value."""
    chunks = np.ascontiguousarray(signatures.reshape(-1, CHUNKS, WIDTH)).view(np.uint64)
    keys = np.empty((len(signatures), CHUNKS, WIDTH), dtype=np.uint64)
    for j in range(WIDTH):
        left_out = ~np.uint64(0xFFFF << (16 * j))
        salt = mix(np.arange(CHUNKS, dtype=np.uint64) * np.uint64(WIDTH) + np.uint64(j + 1))
        keys[:, :, j] = mix((chunks[:, :, 0] & left_out) ^ salt)
    return keys.reshape(len(signatures), -1)


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, class (set digest), signature``, one row for each row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, sets in shingle_sets(batch.column(2), words):
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[rows],
                    batch.column(1)[rows],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([signature(s) if len(s) else None for s in sets], pa.binary()),
                ], ["doc_id", "text_key", "n_shingles", "class", "signature"])

    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        run, "doc_id long, text_key long, n_shingles long, class binary, signature binary")


def bucket_rows(classes: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """``key, at, node`` (and ``extra``) for every chunk key of every class; ``at`` numbers the key."""
    kinds = dict(classes.dtypes)
    names = ["key", "at", "node", *extra]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, PART):
                part = batch.slice(lo, PART)
                keys = chunk_keys(read_signatures(part.column(1).to_pylist())[0]).view(np.int64)
                rows = pa.array(np.repeat(np.arange(len(keys)), keys.shape[1]))
                at = np.tile(np.arange(keys.shape[1], dtype=np.int32), len(keys))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(at), part.column(0).take(rows), *(part.column(2 + i).take(rows) for i in range(len(extra)))], names)

    schema = "key long, at int, node long" + "".join(f", `{c}` {kinds[c]}" for c in extra)
    return classes.select("node", "signature", *extra).mapInArrow(run, schema)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets reach the similarity."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"), F.col("n").alias("na"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"), F.col("n").alias("nb"))
    close = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    met = pairs.select("a", "b").join(left, "a").join(right, "b").filter(close).select("a", "b", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for sa, sb in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(sa.as_buffer(), np.uint64), np.frombuffer(sb.as_buffer(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return met.mapInArrow(run, "a long, b long")


class Cell:
    """Members of one cell and their pairs within reach."""

    def __init__(self, at: tuple, rows: list[tuple]):
        self.place, self.crossed = at, at[1] != at[2]
        block, node, label, n, signatures, *sets = zip(*rows)
        self.node, self.block, self.label, self.n = node, np.array(block), np.array(label), np.array(n)
        self.low, self.more = read_signatures(signatures)
        self.sets = [np.frombuffer(x, np.uint64) for x in sets[0]] if sets else []
        # members of a set that any other set of the cell has
        self.known = self.shared_members() if sets else self.n

    def shared_members(self) -> np.ndarray:
        owner = np.repeat(np.arange(len(self.sets)), [len(x) for x in self.sets])
        _, which, count = np.unique(np.concatenate(self.sets), return_inverse=True, return_counts=True)
        return np.bincount(owner, weights=count[which] > 1, minlength=len(self.sets)).astype(np.int64)

    def near(self, i: int, percent: int) -> np.ndarray:
        """Later members of other components within reach of member ``i``."""
        rest = np.flatnonzero(self.label[i + 1:] != self.label[i]) + i + 1
        if self.crossed:
            rest = rest[self.block[rest] != self.block[i]]
        # the most that the two sets can share, by their sizes and by what is known in the cell
        most = np.minimum(np.minimum(self.n[rest], self.n[i]), np.minimum(self.known[rest], self.known[i]))
        rest = rest[100 * most >= percent * (self.n[rest] + self.n[i] - most)]
        if not len(rest):
            return rest
        far = (self.low[rest] != self.low[i]).sum(axis=1)
        rest, far = rest[far <= REACH], far[far <= REACH]
        return rest[far + (self.more[rest] != self.more[i]).sum(axis=1) <= FAR]

    def pairable(self, percent: int) -> list[int]:
        """Nodes with at least one pair."""
        out = np.zeros(len(self.node), dtype=bool)
        for i in range(len(self.node) - 1):
            rest = self.near(i, percent)
            out[rest] = True
            out[i] |= len(rest) > 0
        return [self.node[i] for i in np.flatnonzero(out)]

    def links(self, percent: int) -> list[tuple[int, int]]:
        """Confirmed links, without those between members that earlier ones have merged."""
        out = []
        for i in range(len(self.sets) - 1):
            for j in self.near(i, percent).tolist():
                if self.label[i] != self.label[j]:
                    shared = len(np.intersect1d(self.sets[i], self.sets[j], assume_unique=True))
                    if 100 * shared >= percent * (len(self.sets[i]) + len(self.sets[j]) - shared):
                        out.append((self.node[i], self.node[j]))
                        self.label[self.label == self.label[j]] = self.label[i]
        return out


CELL_KEYS = ("family", "x", "y")


def by_cell(rows: DataFrame, columns: tuple[str, ...], work, names: tuple[str, ...]) -> DataFrame:
    """``work(Cell)`` for each cell with two or more members; its results are rows of the longs ``names``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def close() -> list:
            return work(Cell(at, held)) if len(held) > 1 else []

        for batch in batches:
            out = []
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if row[:3] != at:
                    out += close()
                    at, held = row[:3], []
                held.append(row[3:])
            yield table_of(out)
        yield table_of(close())

    def table_of(out: list) -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], list(names))

    dealt = rows.select(*CELL_KEYS, *columns).repartition(*CELL_KEYS).sortWithinPartitions(*CELL_KEYS)
    return dealt.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def meeting_pairs(rows: DataFrame, turn: int) -> DataFrame:
    """One pair ``a, b`` for each class in a bucket with several components: the class of another
    component it shares most buckets with, among one class per bucket: the most popular one, and in later
    turns one drawn by a hash.  ``rows`` has ``key, node, label, pop``."""
    drawn = F.xxhash64("node", F.lit(turn))
    by = F.col("pop") * 1024 + F.pmod(drawn, F.lit(1024)) if turn == 0 else drawn
    chosen = rows.withColumn("by", by).groupBy("key").agg(
        F.max_by("node", "by").alias("b"), F.max_by("label", "by").alias("other"), F.min("label").alias("low"), F.max("label").alias("high"))
    chosen = chosen.filter("low != high").select("key", "b", "other")
    met = rows.join(chosen, "key").filter("label != other").groupBy(F.col("node").alias("a"), "b").agg(F.count(F.lit(1)).alias("shared"))
    return met.groupBy("a").agg(F.max_by("b", F.col("shared") * 1024 + F.pmod(F.xxhash64("b"), F.lit(1024))).alias("b"))


def mixed_keys(rows: DataFrame) -> DataFrame:
    """Buckets that hold several components, with their most popular class: ``key, family``."""
    by = F.col("pop") * 1024 + F.pmod(F.xxhash64("node"), F.lit(1024))
    ends = rows.withColumn("by", by).groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.max_by("node", "by").alias("family"))
    return ends.filter("low != high").select("key", "family")


def families(members: DataFrame) -> DataFrame:
    """``family, node``: each class once in every family whose buckets it is in."""
    rows = bucket_rows(members, ("label", "pop"))
    return rows.select("key", "node").join(mixed_keys(rows), "key").select("family", "node").distinct()


def cross_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components: ``members`` has ``node, signature, n, label, pop``."""
    rows = cut_lineage(families(members))
    sizes = rows.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / CELL).alias("cells"))
    rows = rows.join(sizes, "family").withColumn("block", F.pmod(F.xxhash64("node"), F.col("cells")))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1)))
    rows = rows.withColumns({"x": F.least("block", "with"), "y": F.greatest("block", "with")}).join(members.drop("class", "first_id", "text_key"), "node")
    facts = ("block", "node", "label", "n", "signature")

    def chosen(cell: Cell) -> list:
        return [(*cell.place, node) for node in cell.pairable(percent)]

    picked = by_cell(rows, facts, chosen, (*CELL_KEYS, "node"))
    ready = picked.join(members.drop("class", "first_id", "text_key"), "node").join(sets.select("node", "shingles"), "node")
    ready = ready.join(sizes, "family").withColumn("block", F.pmod(F.xxhash64("node"), F.col("cells")))
    return by_cell(ready, (*facts, "shingles"), lambda cell: cell.links(percent), ("a", "b"))


def with_labels(members: DataFrame, known: DataFrame | None) -> DataFrame:
    if known is None:
        return members.withColumn("label", F.col("node"))
    return members.join(known, "node", "left").withColumn("label", F.coalesce("label", "node"))


def full_sets(docs: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """``node, n, shingles`` of the classes in ``members``, from the text of one of their rows."""
    wanted = members.select(F.coalesce("first_id", F.lit(LAST_ID)).alias("id"), "text_key").distinct()
    texts = docs.select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), F.xxhash64("text").alias("text_key"), "text")
    texts = texts.join(wanted, ["id", "text_key"]).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sets in shingle_sets(batch.column(0), words):
                sets = [s for s in sets if len(s)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([set_digest(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary())], ["class", "n", "shingles"])

    made = texts.mapInArrow(run, "class binary, n long, shingles binary").join(members.select("class", "node"), "class")
    return made.groupBy("node").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Components of texts whose shingle sets have a Jaccard similarity of at least ``percent``.

    Returns ``doc_id, n_shingles, component_id, kept, text_key, group`` with one row for each row of
    ``docs``.  Words ``[^\\x20\\x09-\\x0D]+`` of the whole text, A-Z lower-cased, in runs of
    ``words``.  A text without words (NULL, empty, blanks) has no shingles and is its own
    component.  ``component_id`` is the smallest doc_id reachable; missing ids do not count for it,
    and it is NULL where no id is known.  ``kept`` says that the two are equal, so rows
    repeated under one id are all kept or all dropped.  ``text_key`` is ``xxhash64(text)``; ``group``
    numbers the component for this run, also where no id is known, and is NULL for a text without words.
    """
    spark = docs.sparkSession
    found = cut_lineage(signatures(docs, words))
    classes = found.filter("n_shingles > 0").groupBy("class").agg(
        F.min("doc_id").alias("first_id"), F.coalesce(F.min_by("text_key", "doc_id"), F.min("text_key")).alias("text_key"),
        F.first("signature").alias("signature"), F.first("n_shingles").alias("n"))
    # numbers given once, in the checkpoint: joins and folds then work on plain longs
    classes = cut_lineage(classes.withColumn("node", F.monotonically_increasing_id()))

    rows = bucket_rows(classes).select("key", "node")
    buckets = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    popular = rows.join(buckets, "key").groupBy("node").agg(F.sum("members").alias("pop"))
    members = cut_lineage(classes.join(popular, "node").select("class", "node", "first_id", "text_key", "signature", "n", "pop"))
    del rows, buckets, popular
    release(spark)
    sets = cut_lineage(full_sets(docs, members, words))
    release(spark)

    links, known, turn, open_ = None, None, 0, members
    while True:
        new = cut_lineage(confirm(meeting_pairs(bucket_rows(with_labels(open_, known), ("label", "pop")), turn), sets, percent))
        merging = new.count()
        if turn and not merging:
            break
        links = new if links is None else links.union(new)
        known = components(links)
        release(spark)
        # only classes in buckets with several components go on
        left = families(with_labels(open_, known)).select("node").distinct()
        open_ = cut_lineage(open_.join(left, "node", "left_semi"))
        turn += 1
        # what is left is compared in cells, once rounds merge little
        if merging * SLOW < open_.count():
            break
    if not open_.isEmpty():
        links = links.union(cut_lineage(cross_links(cut_lineage(with_labels(open_, known)), sets, percent)))
        known = components(links)

    placed = classes.join(known, "node", "left").select("class", "first_id", F.coalesce("label", "node").alias("label"))
    lowest = placed.groupBy("label").agg(F.min("first_id").alias("component"))
    of_class = placed.join(lowest, "label").select("class", "component", F.col("label").alias("group"))
    out = found.select("doc_id", "text_key", "n_shingles", "class").join(of_class, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"), "text_key", "group")
