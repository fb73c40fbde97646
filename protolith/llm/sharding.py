"""Balanced label propagation: linked documents move together while the shards stay even.

DataFrame operations only.  Documents with equal texts are linked.  The groups start end to end in
the order of their hash, cut into shards of equal many rows, so that only the groups on a cut (fewer
than there are shards) and those larger than a shard are split.  In each round the linked documents
of a split group want the shard that holds most of the group and has room; who may move is decided
by a histogram over hash bins (a fixed number of rows), filled up to each shard's room, and row by
row where no whole bin fits.  It ends when nothing can move.  Unlinked documents have no wish, so
they fill the shards up to sizes that differ by one row at most (law ``rows``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from protolith.session import cut_lineage

SHARDS = 8
#: Bins of the move histogram and of the numbering; both are fixed, so windows over them are bounded.
GROUP_BINS, ROW_BINS = 64, 64
NUMBER_BINS = 1024


def _pick(values: dict[int, int], key: str) -> Column:
    """The value of ``values`` for a column, as one expression."""
    out = F.lit(0).cast("long")
    for k, v in values.items():
        out = F.when(F.col(key) == k, F.lit(v).cast("long")).otherwise(out)
    return out


def numbered(rows: DataFrame, key: str) -> DataFrame:
    """Add ``number``: 0, 1, ... inside each value of ``key`` without one task for a whole value."""
    binned = rows.withColumn("bin", F.pmod(F.xxhash64("row", F.lit(5)), F.lit(NUMBER_BINS)))
    sizes = binned.groupBy(key, "bin").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(key).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(key, "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy(key, "bin").orderBy("row")
    placed = binned.withColumn("place", F.row_number().over(inside) - 1)
    return placed.join(F.broadcast(offsets), [key, "bin"]).withColumn("number", F.col("offset") + F.col("place")).drop("bin", "offset", "place")


def propagate(linked: DataFrame, room: int, shards: int) -> DataFrame:
    """Rounds of moves of ``row, group, shard`` until nothing moves; no move takes a shard beyond ``room`` rows."""
    while True:
        # one row per shard reaches the driver
        sizes = {r.shard: r.n for r in linked.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
        free = {s: max(0, room - sizes.get(s, 0)) for s in range(shards)}
        held = linked.groupBy("group", "shard").agg(F.count(F.lit(1)).alias("n"))
        inviting = held.withColumn("free", _pick(free, "shard")).filter("free > 0")
        goal = inviting.groupBy("group").agg(F.max(F.struct("n", (-F.col("shard")).alias("back"))).alias("best")).select(
            "group", F.col("best.n").alias("goal_n"), (-F.col("best.back")).alias("goal"))
        wish = linked.join(goal, "group", "left").join(held.withColumnRenamed("n", "here_n"), ["group", "shard"], "left")
        better = (F.col("goal") != F.col("shard")) & (
            (F.col("goal_n") > F.col("here_n")) | ((F.col("goal_n") == F.col("here_n")) & (F.col("goal") < F.col("shard"))))
        bin = F.pmod(F.xxhash64("group"), F.lit(GROUP_BINS)) * ROW_BINS + F.pmod(F.xxhash64("row", F.lit(3)), F.lit(ROW_BINS))
        wish = cut_lineage(wish.select("row", "group", "shard", F.when(better, F.col("goal")).alias("goal"), bin.alias("bin")))
        asked = wish.filter("goal IS NOT NULL").groupBy("goal", "bin").agg(F.count(F.lit(1)).alias("n"))
        filled = F.sum("n").over(Window.partitionBy("goal").orderBy("bin"))
        granted = asked.withColumn("filled", filled).filter(F.col("filled") <= _pick(free, "goal")).select("goal", "bin", F.lit(True).alias("granted"))
        # no bin fits: as many rows as there is room for
        if not granted.limit(1).count():
            asking = numbered(wish.filter(F.col("goal").isNotNull()).select("row", "goal"), "goal")
            granted = cut_lineage(asking.filter(F.col("number") < _pick(free, "goal")).select("row", F.lit(True).alias("granted")))
            if not granted.limit(1).count():
                return linked
            moved = wish.join(granted, "row", "left")
        else:
            moved = wish.join(F.broadcast(granted), ["goal", "bin"], "left")
        linked = cut_lineage(moved.select("row", "group", F.when(F.col("granted"), F.col("goal")).otherwise(F.col("shard")).alias("shard")))


def packed(linked: DataFrame, groups: DataFrame, shards: int) -> DataFrame:
    """``row, group, shard`` of ``linked`` (``row, group``): the groups of ``groups`` (``group, n``) end to end, cut into ``shards`` even parts."""
    binned = groups.withColumn("bin", F.pmod(F.xxhash64("group", F.lit(1)), F.lit(NUMBER_BINS)))
    sizes = binned.groupBy("bin").agg(F.sum("n").alias("size")).withColumn("all", F.lit(0))
    before = Window.partitionBy("all").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bin", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("bin").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    laid = binned.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(F.broadcast(offsets), "bin")
    laid = laid.select("group", (F.col("offset") + F.col("inside")).alias("begin"), (F.col("offset") + F.col("inside") + F.col("n")).alias("end"))
    total = groups.agg(F.sum("n")).first()[0] or 0
    cuts = [s * (total // shards) + min(s, total % shards) for s in range(1, shards)]
    shard_of = lambda place: sum((F.when(place >= c, 1).otherwise(0) for c in cuts), F.lit(0))
    laid = cut_lineage(laid.withColumn("shard", shard_of(F.col("begin"))).withColumn("split", shard_of(F.col("end") - 1) != F.col("shard")))
    whole = linked.join(laid.filter("not split").select("group", "shard"), "group").select("row", "group", "shard")
    # fewer groups than shards lie on a cut, so their rows are numbered by bins
    split = linked.join(F.broadcast(laid.filter("split").select("group", "begin")), "group")
    split = numbered(split, "group").select("row", "group", shard_of(F.col("begin") + F.col("number")).alias("shard"))
    return whole.union(split)


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``, one row for each row of ``docs``.

    ``size`` is the text's UTF-8 bytes (NULL: none) plus 1 and ``text_crc32`` the checksum of its bytes
    (NULL: of none).  Row counts of the shards differ by at most one, and slots count from 0 in every
    shard.  NULL texts are linked with nothing; empty texts are equal texts like others.  Repeated rows
    and missing ids are rows of their own.
    """
    text = F.col("text")
    base = docs.select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"), F.when(text.isNotNull(), F.xxhash64(text)).alias("group"))
    # row numbers given once, in the checkpoint
    base = cut_lineage(base.withColumn("row", F.monotonically_increasing_id()))
    total = base.count()
    quota = {s: total // shards + (s < total % shards) for s in range(shards)}

    groups = base.filter("group IS NOT NULL").groupBy("group").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    groups = cut_lineage(groups)
    linked = base.select("row", "group").join(groups.select("group"), "group").select("row", "group")
    linked = cut_lineage(packed(linked, groups, shards))
    linked = propagate(linked, total // shards, shards)

    linked = cut_lineage(numbered(linked.select("row", "shard"), "shard"))
    stay = linked.filter(F.col("number") < _pick(quota, "shard"))
    counts = {r.shard: r.n for r in stay.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    rest = base.select("row").join(stay.select("row"), "row", "left_anti").withColumn("all", F.lit(0))
    rest = numbered(rest, "all")
    to, slot, begin = F.lit(None).cast("int"), F.lit(None).cast("long"), 0
    for s in range(shards):
        open_ = quota[s] - counts.get(s, 0)
        here = (F.col("number") >= begin) & (F.col("number") < begin + open_)
        to = F.when(here, F.lit(s)).otherwise(to)
        slot = F.when(here, F.col("number") - begin + counts.get(s, 0)).otherwise(slot)
        begin += open_
    placed = stay.select("row", F.col("shard").cast("int").alias("shard"), F.col("number").cast("long").alias("slot")).union(
        rest.select("row", to.alias("shard"), slot.cast("long").alias("slot")))
    return base.join(placed, "row").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
