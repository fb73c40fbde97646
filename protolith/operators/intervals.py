"""Interval joins and folds that never enumerate the pairs of a group.

An interval ``[start, end)`` is cut into aligned power-of-two blocks, at most two
per size (and as many as it takes of the largest size).  A position lies in exactly one block of each size, so *which intervals
cover this position* becomes an equi-join on ``(seqid, level, block)``: no
candidate pair is produced that is not a result, and one long sequence spreads
over all its blocks.  Folds over the covering set aggregate per block first
(map-side) and only then meet the positions.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .ordered import climb, dealt, number_rows, scan

BIN = 1 << 16
# blocks stop growing here: one join key never stands for more than 65,536 positions
TOP_LEVEL = 16
RADIX_BITS = 10
#: Segments with more covering intervals are folded without pairing them.
SHALLOW = 256
#: Buckets of a fold in place hold at most so many spans; medians look at pairs, so theirs hold fewer.
CROWD, MEDIAN_CROWD = 1 << 17, 1 << 14
PAIRS = 1 << 21


def block_levels(start: Column, end: Column) -> Column:
    """Largest block size (as a power of two) that can occur in the interval."""
    size = F.greatest(end - start, F.lit(1)).cast("double")
    return F.least(F.floor(F.log2(size)).cast("int"), F.lit(TOP_LEVEL))


def with_cover(df: DataFrame, start: str, end: str) -> DataFrame:
    """One row per block of the interval: adds ``level`` and ``block``.

    Empty intervals have no block.
    """
    s, e = F.col(start).cast("bigint"), F.col(end).cast("bigint")
    lo, hi = F.col("__lo"), F.col("__hi")
    per_level = (
        df.filter(s < e)
        .select("*", F.explode(F.sequence(F.lit(0), block_levels(s, e))).alias("level"))
        .withColumn("__lo", _shift(s + _power(F.col("level")) - 1, F.col("level")))
        .withColumn("__hi", _shift(e, F.col("level")))
        .filter(lo < hi)
    )
    ends = F.array(
        F.when(lo.bitwiseAND(F.lit(1)) == 1, lo), F.when(hi.bitwiseAND(F.lit(1)) == 1, hi - 1)
    )
    # the top size takes all that is left instead of moving on to larger blocks
    blocks = F.when(F.col("level") < TOP_LEVEL, ends).otherwise(F.sequence(lo, hi - 1))
    return (
        per_level.select("*", F.explode(blocks).alias("block"))
        .filter(F.col("block").isNotNull()).drop("__lo", "__hi")
    )


def _shift(value: Column, bits: Column) -> Column:
    return F.call_function("shiftright", value, bits)


def _power(level: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), level)


def with_probes(df: DataFrame, position: str, levels: Column) -> DataFrame:
    """One row per block size around a position: adds ``level`` and ``block``."""
    return (
        df.withColumn("level", F.explode(F.sequence(F.lit(0), levels)))
        .withColumn("block", _shift(F.col(position).cast("bigint"), F.col("level")))
    )


def top_level(df: DataFrame, start: str, end: str) -> Column:
    """The largest block size in the data, as a scalar subquery."""
    return F.coalesce(
        df.agg(F.max(block_levels(F.col(start), F.col(end))).alias("m")).scalar(), F.lit(0)
    )


def point_join(points: DataFrame, position: str, spans: DataFrame, start: str, end: str,
               on: list[str]) -> DataFrame:
    """All (point, span) pairs with ``start <= position < end``, inside equal ``on`` keys."""
    probes = with_probes(points, position, top_level(spans, start, end))
    return probes.join(with_cover(spans, start, end), [*on, "level", "block"]).drop("level", "block")


def overlap_join(left: DataFrame, left_span: tuple[str, str], right: DataFrame,
                 right_span: tuple[str, str], on: list[str]) -> DataFrame:
    """All overlapping pairs, each exactly once.

    Two intervals overlap when the left one starts inside the right one, or the
    right one starts strictly inside the left one; the two cases exclude each other.
    Column names other than ``on`` must differ between the sides.
    """
    (ls, le), (rs, re) = left_span, right_span
    left = left.filter(F.col(ls) < F.col(le))
    right = right.filter(F.col(rs) < F.col(re))
    first = point_join(left, ls, right, rs, re, on)
    inner = left.withColumn("__ls1", F.col(ls) + 1)
    second = point_join(right, rs, inner, "__ls1", le, on).drop("__ls1")
    return first.unionByName(second.select(*first.columns))


def segments(df: DataFrame, seqid: str, start: str, end: str, bin_size: int = BIN) -> DataFrame:
    """Elementary segments ``seqid, start, end`` between neighbouring boundaries.

    Gaps between intervals are included; a fold over them finds no interval and
    drops them.
    """
    points = df.select(
        F.col(seqid).alias("seqid"),
        F.explode(F.array(F.col(start).cast("bigint"), F.col(end).cast("bigint"))).alias("start"),
    ).distinct()
    cut = scan(points, ["seqid"], F.floor(F.col("start") / bin_size), ["start"],
               leads={"end": F.col("start")})
    return cut.filter(F.col("end").isNotNull())


def fold_overlaps(df: DataFrame, seqid: str, start: str, end: str, values: list[str],
                  reducer: str, cut: DataFrame | None = None) -> DataFrame:
    """Reduce values over the intervals covering each elementary segment.

    ``cut`` gives other segments (``seqid, start, end``) than the intervals' own; they
    must not cross an interval's boundary.

    ``reducer`` is min, max, mean or median; NULL and NaN values are skipped, segments
    with no covering row are dropped, a segment whose values are all NULL stays.

    One sweep over all boundaries gives each segment its depth and its number among the shallow segments
    (at most ``SHALLOW`` covering intervals).  An interval is paired with the shallow segments between the
    numbers of its two ends, so there are at most ``SHALLOW`` pairs for a segment, for all
    columns together.  Deeper segments are folded without pairs (:func:`_fold_blocks`, :func:`_fold_median`).
    """
    spans = df.select(
        F.col(seqid).alias("seqid"), F.col(start).cast("bigint").alias("s"),
        F.col(end).cast("bigint").alias("e"),
        *[F.when(~F.isnan(F.col(v).cast("double")), F.col(v).cast("double")).alias(v) for v in values],
    ).filter("s < e")
    spans = stored(spans, "spans")
    cut = segments(spans, "seqid", "s", "e") if cut is None else cut
    steps = spans.select("seqid", F.inline(F.array(
        F.struct(F.col("s").alias("p"), F.lit(1).cast("bigint").alias("d")), F.struct(F.col("e").alias("p"), F.lit(-1).cast("bigint").alias("d")))))
    steps = steps.withColumn("end", F.lit(None).cast("bigint")).unionByName(cut.select(
        "seqid", F.col("start").cast("bigint").alias("p"), F.lit(0).cast("bigint").alias("d"), F.col("end").cast("bigint").alias("end")))
    events = dealt(steps.groupBy("seqid", "p").agg(F.sum("d").alias("d"), F.max("end").alias("end")), ["seqid", "p"], label="events")
    # the steps of a sequence add up to nothing, so one running sum serves them all
    swept = climb(events.rows, events.bins, sums={"__before": F.col("d")}).withColumn("depth", F.col("__before") + F.col("d"))
    covered = F.col("end").isNotNull() & (F.col("depth") > 0)
    ranks = climb(swept, events.bins, sums={"shallow": (covered & (F.col("depth") <= SHALLOW)).cast("bigint"),
                                            "deep": (covered & (F.col("depth") > SHALLOW)).cast("bigint")})
    places = stored(ranks.select("seqid", "p", "end", "depth", "shallow", "deep"), "places")

    def at(name: str) -> DataFrame:
        return places.select(F.col("seqid"), F.col("p").alias(name), F.struct("shallow", "deep").alias(f"__{name}"))

    # a span without a place of its own number on either side lies between the segments asked for
    ranged = spans.join(at("s"), ["seqid", "s"]).join(at("e"), ["seqid", "e"])
    any_deep = not places.filter((F.col("depth") > SHALLOW) & F.col("end").isNotNull()).limit(1).isEmpty()
    if any_deep:
        ranged = stored(ranged, "ranged")
    pairs = ranged.filter(F.col("__s.shallow") < F.col("__e.shallow")).select(
        F.explode(F.sequence(F.col("__s.shallow"), F.col("__e.shallow") - 1)).alias("shallow"), *values)
    folded = pairs.groupBy("shallow").agg(*[DIRECT[reducer](v).alias(v) for v in values])
    where = places.filter(covered & (F.col("depth") <= SHALLOW)).select("shallow", "seqid", F.col("p").alias("start"), "end")
    out = where.join(folded, "shallow").select("seqid", "start", "end", *values)
    if not any_deep:
        return out
    deep = places.filter(covered & (F.col("depth") > SHALLOW)).select("seqid", F.col("p").alias("start"), "end")
    reaching = ranged.filter(F.col("__s.deep") < F.col("__e.deep")).select("seqid", "s", "e", *values)
    fold = _fold_median if reducer == "median" else partial(_fold_blocks, reducer=reducer)
    return out.unionByName(fold(reaching, deep, values))


def _exact_median(value: str) -> Column:
    known = F.sort_array(F.collect_list(value))
    n = F.size(known)
    middle = (F.get(known, F.floor((n - 1) / 2).cast("int")) + F.get(known, F.floor(n / 2).cast("int"))) / 2
    return F.when(n > 0, middle)


DIRECT = {"min": F.min, "max": F.max, "mean": F.avg, "median": _exact_median}


def _fold_blocks(spans: DataFrame, cut: DataFrame, values: list[str], reducer: str) -> DataFrame:
    """Min, max and mean per block (map side) before blocks meet the segments inside them."""
    partials = {
        "min": lambda v: [F.min(v).alias(f"{v}__a")],
        "max": lambda v: [F.max(v).alias(f"{v}__a")],
        "mean": lambda v: [F.sum(v).alias(f"{v}__a"), F.count(v).alias(f"{v}__n")],
    }[reducer]
    final = {
        "min": lambda v: F.min(f"{v}__a").alias(v),
        "max": lambda v: F.max(f"{v}__a").alias(v),
        "mean": lambda v: (F.sum(f"{v}__a") / F.nullif(F.sum(f"{v}__n"), F.lit(0))).alias(v),
    }[reducer]
    blocks = (
        with_cover(spans, "s", "e").groupBy("seqid", "level", "block")
        .agg(*[a for v in values for a in partials(v)])
    )
    probes = with_probes(cut, "start", top_level(spans, "s", "e"))
    return (
        probes.join(blocks, ["seqid", "level", "block"])
        .groupBy("seqid", "start", "end").agg(*[final(v) for v in values])
    )


def _fold_median(spans: DataFrame, cut: DataFrame, values: list[str]) -> DataFrame:
    """Exact medians of all columns at deep segments, by one radix descent over value ranks.

    The k-th smallest covering value is found digit by digit: per block, how many
    covering intervals have a rank that starts with the digits found so far.  The column is part of
    every key, so all columns go down together; each round is one aggregation and one equi-join, and
    a position covered a million times costs as much as one covered a thousand times.
    """
    base = 1 << RADIX_BITS
    cells = with_cover(spans, "s", "e").select("seqid", "level", "block", F.posexplode(F.array(*values)).alias("c", "value"))
    cells = stored(cells.filter(F.col("value").isNotNull()).groupBy("seqid", "level", "block", "c", "value").agg(F.count(F.lit(1)).alias("n")), "cells")
    ranks = stored(number_rows(cells.select("c", "value").distinct(), ["value"], out="rank", keys=["c"]), "ranks")
    blocks = stored(cells.join(ranks, ["c", "value"]).drop("value"), "blocks")
    largest = ranks.agg(F.max("rank").alias("m")).collect()[0].m or 0
    digits = 1
    while (1 << (RADIX_BITS * digits)) <= largest:
        digits += 1
    levels = F.coalesce(blocks.agg(F.max("level")).scalar(), F.lit(0))
    seg = ["seqid", "start", "end"]
    depth = (
        with_probes(cut, "start", levels)
        .join(blocks.groupBy("seqid", "level", "block", "c").agg(F.sum("n").alias("n")), ["seqid", "level", "block"])
        .groupBy(*seg, "c").agg(F.sum("n").alias("n"))
    )
    # positions of the two middle values (equal when the count is odd)
    wanted = depth.select(
        *seg, "c", F.lit(0).cast("bigint").alias("prefix"),
        F.explode(F.array_distinct(F.array(F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)))).alias("k"),
    )
    for digit in reversed(range(digits)):
        scale = 1 << (RADIX_BITS * digit)
        counts = blocks.groupBy(
            "seqid", "level", "block", "c",
            F.floor(F.col("rank") / (scale * base)).cast("bigint").alias("prefix"),
            F.pmod(F.floor(F.col("rank") / scale), F.lit(base)).cast("int").alias("digit"),
        ).agg(F.sum("n").alias("n"))
        ask = [*seg, "c", "prefix", "k"]
        found = (
            with_probes(wanted, "start", levels)
            .join(counts, ["seqid", "level", "block", "c", "prefix"])
            .groupBy(*ask, "digit").agg(F.sum("n").alias("n"))
        )
        # at most 2**RADIX_BITS rows per question
        upto = Window.partitionBy(*ask).orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
        wanted = stored(
            found.withColumn("upto", F.sum("n").over(upto))
            .filter((F.col("k") < F.col("upto")) & (F.col("k") >= F.col("upto") - F.col("n")))
            .select(*seg, "c", (F.col("prefix") * base + F.col("digit")).alias("prefix"),
                    (F.col("k") - (F.col("upto") - F.col("n"))).alias("k")), "wanted")
    found = wanted.withColumnRenamed("prefix", "rank").join(ranks, ["c", "rank"]).groupBy(*seg).agg(
        *[F.avg(F.when(F.col("c") == i, F.col("value"))).alias(v) for i, v in enumerate(values)])
    return cut.join(found, seg, "left")


def bucket_bits(spans: DataFrame, start: str, end: str) -> int:
    """Buckets of 64 mean lengths, as a power of two: cutting at them makes at most twice as many pieces."""
    mean = spans.filter(F.col(start) < F.col(end)).agg(F.avg(F.col(end) - F.col(start))).first()[0] or 1
    return min(max(int(np.ceil(np.log2(64 * mean))), 12), 40)


def with_buckets(spans: DataFrame, start: str, end: str, bits: int) -> DataFrame:
    """One row for each ``bucket`` a span touches, that of its end included; a row without a length touches those of its points."""
    s, e = (F.call_function("shiftright", F.col(c).cast("bigint"), F.lit(bits)) for c in (start, end))
    points = F.array_distinct(F.array_compact(F.array(s, e)))
    return spans.withColumn("bucket", F.explode(F.when(F.col(start) < F.col(end), F.sequence(s, e)).otherwise(points)))


def crowded(spans: DataFrame, seqid: str, start: str, end: str, bits: int, reducer: str) -> DataFrame:
    """Sequences with a bucket that holds too many spans for one task."""
    limit = MEDIAN_CROWD if reducer == "median" else CROWD
    counts = with_buckets(spans.select(seqid, start, end), start, end, bits).groupBy(seqid, "bucket").count()
    return stored(counts.filter(F.col("count") > limit).select(seqid).distinct(), "crowded")


def fold_buckets(spans: DataFrame, values: list[str], reducer: str, bits: int) -> DataFrame:
    """The fold of :func:`fold_overlaps` over sequences without a crowded bucket, in one shuffle.

    ``spans``: ``seqid, start, end, once, *values``.  Every row cuts segments; rows with a ``once`` have values, and those of
    one ``once`` count once on a segment.  Each bucket is swept by itself; segments that a bucket's edge cuts in two
    are put together again.
    """
    known = [F.when(~F.isnan(F.col(v).cast("double")), F.col(v).cast("double")).alias(v) for v in values]
    rows = spans.filter("seqid IS NOT NULL").select("seqid", F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"), "once", *known)
    dealt_out = with_buckets(rows, "start", "end", bits).repartition("seqid", "bucket").sortWithinPartitions("seqid", "bucket")
    schema = T.StructType([rows.schema["seqid"], *(T.StructField(c, T.LongType()) for c in ("start", "end")),
                           *(T.StructField(v, T.DoubleType()) for v in values),
                           *(T.StructField(c, T.BooleanType()) for c in ("open", "edge"))])
    cells = stored(dealt_out.mapInArrow(partial(_sweep_buckets, values=values, reducer=reducer, bits=bits), schema), "cells")
    # a segment goes on in the next bucket as long as that one opens without a boundary
    edges = scan(cells.filter("edge"), ["seqid"], F.shiftright("start", bits + 10), ["start"],
                 sums={"__before": (~F.col("open")).cast("bigint")})
    whole = edges.groupBy("seqid", (F.col("__before") + (~F.col("open")).cast("bigint")).alias("__chain")).agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min_by(F.struct(*values), "start").alias("__v"))
    return cells.filter("NOT edge").select("seqid", "start", "end", *values).unionByName(
        whole.select("seqid", "start", "end", *(F.col("__v")[v].alias(v) for v in values)))


def _sweep_buckets(batches, values: list[str], reducer: str, bits: int):
    """Arrow batches sorted by sequence and bucket to the segments of each bucket; the last bucket waits for the next batch."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
        last = _heads(table)[-1] if table.num_rows else 0
        if last:
            yield from _sweep(table.slice(0, last), values, reducer, bits)
        held = table.slice(last)
    if held is not None and held.num_rows:
        yield from _sweep(held, values, reducer, bits)


def _heads(table: pa.Table) -> np.ndarray:
    """The first row of each bucket."""
    seqid = table["seqid"].combine_chunks().dictionary_encode()
    seqid = (seqid.combine_chunks() if isinstance(seqid, pa.ChunkedArray) else seqid).indices.to_numpy(zero_copy_only=False)
    bucket = table["bucket"].to_numpy()
    return np.flatnonzero(np.r_[True, (seqid[1:] != seqid[:-1]) | (bucket[1:] != bucket[:-1])])


def _sweep(table: pa.Table, values: list[str], reducer: str, bits: int):
    """All segments of whole buckets.  A place is the bucket's number in the table times its width, plus the place in it."""
    heads, width = _heads(table), 1 << bits
    n = len(heads)
    number = np.repeat(np.arange(n), np.diff(np.r_[heads, table.num_rows]))
    bucket = table["bucket"].to_numpy()
    low = bucket << bits
    start, end = (table[c].fill_null(0).to_numpy() for c in ("start", "end"))
    given = [~table[c].is_null().to_numpy() for c in ("start", "end")]
    shift = number * width - low
    real = np.unique(np.concatenate([(p + shift)[ok & (p >> bits == bucket)] for p, ok in zip((start, end), given)]))
    places = np.union1d(real, np.arange(n + 1) * width)
    rows = np.flatnonzero(given[0] & given[1] & (start < end) & ~table["once"].is_null().to_numpy())
    first = np.searchsorted(places, (np.maximum(start, low) + shift)[rows])
    after = np.searchsorted(places, (np.minimum(end, low + width) + shift)[rows])
    rows, first, after = (x[first < after] for x in (rows, first, after))
    if reducer in ("mean", "median") and len(rows):
        # spans of one score that overlap are one span
        once = table["once"].fill_null(0).to_numpy()[rows]
        order = np.lexsort((first, once, number[rows]))
        rows, first, after, once = rows[order], first[order], after[order], once[order]
        run = np.cumsum(np.r_[True, (once[1:] != once[:-1]) | (number[rows][1:] != number[rows][:-1])])
        reach = np.maximum.accumulate(run * (len(places) + 1) + after) - run * (len(places) + 1)
        new = np.flatnonzero(np.r_[True, (run[1:] != run[:-1]) | (first[1:] > reach[:-1])])
        rows, first, after = rows[new], first[new], np.maximum.reduceat(after, new)
    m = len(places) - 1
    kept = np.flatnonzero(_depth(first, after, m) > 0)
    folded = {}
    for v in values:
        ok = ~table[v].is_null().to_numpy()[rows]
        x = table[v].fill_null(0).to_numpy()[rows][ok]
        count = _depth(first[ok], after[ok], m)
        out = _medians(first[ok], after[ok], x, count) if reducer == "median" else _blocks(first[ok], after[ok], x, m, reducer)
        if reducer == "mean":
            out = out / np.maximum(count, 1)
        folded[v] = pa.array(out[kept], mask=(count == 0)[kept])
    begin, stop, of = places[kept], places[kept + 1], places[kept] // width
    base = low[heads][of] - of * width
    opens = (begin % width == 0) & ~np.isin(begin, real)
    columns = {"seqid": table["seqid"].take(pa.array(heads[of])), "start": begin + base, "end": stop + base, **folded,
               "open": opens, "edge": opens | (stop % width == 0)}
    yield from pa.table(columns).combine_chunks().to_batches(max_chunksize=10_000)


def _depth(first: np.ndarray, after: np.ndarray, m: int) -> np.ndarray:
    return np.cumsum(np.bincount(first, minlength=m + 1) - np.bincount(after, minlength=m + 1))[:m]


def _blocks(first: np.ndarray, after: np.ndarray, x: np.ndarray, m: int, reducer: str) -> np.ndarray:
    """Least, greatest or sum of what covers each of ``m`` segments, through aligned power-of-two blocks of segments."""
    fold, none = {"min": (np.minimum, np.inf), "max": (np.maximum, -np.inf), "mean": (np.add, 0.0)}[reducer]
    out, at, lo, hi, level = np.full(m, none), np.arange(m), first, after, 0
    while len(lo):
        block = np.full((m >> level) + 1, none)
        odd = lo & 1 == 1
        fold.at(block, lo[odd], x[odd])
        lo = lo + odd
        odd = (hi & 1 == 1) & (lo < hi)
        fold.at(block, hi[odd] - 1, x[odd])
        out = fold(out, block[at >> level])
        lo, hi, level = lo >> 1, hi >> 1, level + 1
        lo, hi, x = (y[lo < hi] for y in (lo, hi, x))
    return out


def _medians(first: np.ndarray, after: np.ndarray, x: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The mean of the two middle values on each segment, a bounded number of pairs at a time."""
    out, total = np.zeros(len(count)), np.cumsum(count)
    a = 0
    while a < len(count):
        b = max(int(np.searchsorted(total, (total[a - 1] if a else 0) + PAIRS, "right")), a + 1)
        here = (first < b) & (after > a)
        lo, hi = np.maximum(first[here], a), np.minimum(after[here], b)
        size = hi - lo
        segment = np.repeat(lo, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        known = np.repeat(x[here], size)
        known = known[np.lexsort((known, segment))]
        n = count[a:b]
        some, at = n > 0, np.cumsum(n) - n
        out[a:b][some] = (known[(at + (n - 1) // 2)[some]] + known[(at + n // 2)[some]]) / 2
        a = b
    return out
