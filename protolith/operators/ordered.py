"""Order-dependent work without putting a whole group into one task.

Two ways, by what is known about the order:

``dealt`` puts rows of any order into range bins.  The splitters are quantiles that Spark samples from
the data, so bins are even however values are spread; the rows are written with their bin and their place
in it, so a retried task reads the same bins.  Running values are then scanned up a tree of bins: inside
the bins, over the totals of ``FAN`` bins at a time, over their totals, and so on.  No level has a window
over more than one bin or ``FAN`` totals, so neither a hot key nor a table without keys ends in one task.

``scan`` is for rows whose keys come with a coarsening of the order (a position bucket): rows are scanned
inside ``keys + bin`` and the per-bin totals over the bins of a key.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

FAN = 1024
#: Bits of ``monotonically_increasing_id`` that count inside a partition.
PLACE_BITS = 33


class Dealt(NamedTuple):
    rows: DataFrame   # with __bin and __at, written
    bins: int         # bins are numbered 0 .. bins - 1


def dealt(df: DataFrame, order: list, bins: int | None = None, label: str = "dealt") -> Dealt:
    """Rows in ``order``, as ``__bin`` and the place ``__at`` inside it."""
    bins = bins or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(o) if isinstance(o, str) else o for o in order]
    place = F.monotonically_increasing_id()
    rows = df.repartitionByRange(bins, *by).sortWithinPartitions(*by).withColumn("__place", place)
    rows = rows.withColumns({"__bin": F.shiftrightunsigned("__place", PLACE_BITS),
                             "__at": F.col("__place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))}).drop("__place")
    written = stored(rows, label)
    return Dealt(written, bins)


def climb(rows: DataFrame, bins: int, sums: dict[str, Column] | None = None, lags: dict[str, Column] | None = None,
          leads: dict[str, Column] | None = None, peaks: dict[str, Column] | None = None) -> DataFrame:
    """Add running values along ``(__bin, __at)``.

    ``sums``: total over the rows before this one.  ``lags`` / ``leads``: the value on the previous /
    next row, NULL at the ends.  ``peaks``: the largest value up to and with this row, NULLs skipped.
    """
    sums, lags, leads, peaks = sums or {}, lags or {}, leads or {}, peaks or {}
    names = [*sums, *lags, *leads, *peaks]
    assert len(set(names)) == len(names), "output names must differ"
    work = rows.withColumns({f"__v_{n}": v for n, v in {**sums, **lags, **leads, **peaks}.items()})
    inside = Window.partitionBy("__bin").orderBy("__at")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    here = work.select(
        "*", *(F.coalesce(F.sum(f"__v_{n}").over(before), F.lit(0)).alias(f"__l_{n}") for n in sums),
        *(F.lag(F.struct(f"__v_{n}")).over(inside).alias(f"__l_{n}") for n in lags),
        *(F.lead(F.struct(f"__v_{n}")).over(inside).alias(f"__l_{n}") for n in leads),
        *(F.max(f"__v_{n}").over(upto).alias(f"__l_{n}") for n in peaks))
    kept = [F.col(c) for c in rows.columns]
    if bins <= 1:
        return here.select(
            *kept, *(F.col(f"__l_{n}").alias(n) for n in [*sums, *peaks]),
            *(F.col(f"__l_{n}")[f"__v_{n}"].alias(n) for n in [*lags, *leads]))
    totals = work.groupBy("__bin").agg(
        *(F.sum(f"__v_{n}").alias(f"__t_{n}") for n in sums), *(F.max_by(F.struct(f"__v_{n}"), "__at").alias(f"__t_{n}") for n in lags),
        *(F.min_by(F.struct(f"__v_{n}"), "__at").alias(f"__t_{n}") for n in leads), *(F.max(f"__v_{n}").alias(f"__t_{n}") for n in peaks))
    totals = totals.select(F.col("__bin").alias("__at"), F.floor(F.col("__bin") / FAN).cast("long").alias("__bin"), *(f"__t_{n}" for n in names))
    # what comes before a bin is what comes before its total, one level up
    above = climb(totals, -(-bins // FAN), sums={f"__c_{n}": F.col(f"__t_{n}") for n in sums},
                  lags={**{f"__c_{n}": F.col(f"__t_{n}") for n in lags}}, leads={f"__c_{n}": F.col(f"__t_{n}") for n in leads},
                  peaks={f"__p_{n}": F.col(f"__t_{n}") for n in peaks})
    if peaks:
        # the peak of the bins before this one is the running peak on the previous total
        above = climb(above, -(-bins // FAN), lags={f"__c_{n}": F.col(f"__p_{n}") for n in peaks})
    above = above.select(F.col("__at").alias("__kb"), *(f"__c_{n}" for n in names))
    joined = here.join(above, F.col("__bin") == F.col("__kb"))
    either = [F.coalesce(F.col(f"__l_{n}"), F.col(f"__c_{n}"))[f"__v_{n}"].alias(n) for n in [*lags, *leads]]
    return joined.select(*kept, *((F.col(f"__l_{n}") + F.col(f"__c_{n}")).alias(n) for n in sums),
                         *(F.greatest(f"__l_{n}", f"__c_{n}").alias(n) for n in peaks), *either)


def numbered(rows: Dealt, out: str = "number") -> DataFrame:
    """Dense 0-based numbers along the bins; needs no window over rows, as places are known."""
    totals = rows.rows.groupBy("__bin").agg(F.count(F.lit(1)).alias("__n"))
    totals = totals.select(F.col("__bin").alias("__at"), F.floor(F.col("__bin") / FAN).cast("long").alias("__bin"), "__n")
    offsets = climb(totals, -(-rows.bins // FAN), sums={"__offset": F.col("__n")}).select(F.col("__at").alias("__bin"), "__offset")
    return rows.rows.join(offsets, "__bin").withColumn(out, F.col("__at") + F.col("__offset")).drop("__offset")


def number_rows(df: DataFrame, order: list, out: str = "number", keys: list[str] | None = None, bins: int | None = None) -> DataFrame:
    """Dense 0-based numbers in ``order`` (inside ``keys`` when given)."""
    keys = keys or []
    flat = numbered(dealt(df, [*keys, *order], bins), out).drop("__bin", "__at")
    if not keys:
        return flat
    # the number inside a key is the distance from the key's first row
    firsts = flat.groupBy(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys))).agg(F.min(out).alias("__first"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & flat[k].eqNullSafe(firsts[f"__k{i}"])
    return flat.join(firsts, same).withColumn(out, F.col(out) - F.col("__first")).select(*df.columns, out)


def scan(
    df: DataFrame,
    keys: list[str],
    bin: Column,
    order: list,
    sums: dict[str, Column] | None = None,
    lags: dict[str, Column] | None = None,
    leads: dict[str, Column] | None = None,
) -> DataFrame:
    """Add running values to every row, in ``order`` inside ``keys``.

    ``sums``: total over the rows before this one.  ``lags`` / ``leads``: the value
    on the previous / next row, NULL at the ends.
    """
    assert keys, "rows without keys are dealt into bins of their own"
    sums, lags, leads = sums or {}, lags or {}, leads or {}
    names = list(sums) + list(lags) + list(leads)
    work = df.withColumn("__bin", bin)
    for name, value in {**sums, **lags, **leads}.items():
        work = work.withColumn(f"__v_{name}", value)
    position = [F.col(o) if isinstance(o, str) else o for o in order]
    # one plain column keeps the per-bin min/max in a hash aggregate
    work = work.withColumn("__pos", position[0] if len(order) == 1 else F.struct(*position))

    totals = [F.sum(f"__v_{n}").alias(f"__t_{n}") for n in sums]
    totals += [F.max_by(f"__v_{n}", "__pos").alias(f"__t_{n}") for n in lags]
    totals += [F.min_by(f"__v_{n}", "__pos").alias(f"__t_{n}") for n in leads]
    over_bins = Window.partitionBy(*keys).orderBy("__bin")
    before_bin = over_bins.rowsBetween(Window.unboundedPreceding, -1)
    bins = work.groupBy(*keys, "__bin").agg(*totals)
    carried = [F.coalesce(F.sum(f"__t_{n}").over(before_bin), F.lit(0)).alias(f"__c_{n}")
               for n in sums]
    carried += [F.lag(f"__t_{n}").over(over_bins).alias(f"__c_{n}") for n in lags]
    carried += [F.lead(f"__t_{n}").over(over_bins).alias(f"__c_{n}") for n in leads]
    bin_keys = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    bins = bins.select(*bin_keys, F.col("__bin").alias("__kb"), *carried)

    inside = Window.partitionBy(*keys, "__bin").orderBy("__pos")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = [F.coalesce(F.sum(f"__v_{n}").over(before), F.lit(0)).alias(f"__l_{n}") for n in sums]
    local += [F.lag(F.struct(f"__v_{n}")).over(inside).alias(f"__l_{n}") for n in lags]
    local += [F.lead(F.struct(f"__v_{n}")).over(inside).alias(f"__l_{n}") for n in leads]
    rows = work.select("*", *local)

    same_bin = rows["__bin"].eqNullSafe(bins["__kb"])
    for i, k in enumerate(keys):
        same_bin = same_bin & rows[k].eqNullSafe(bins[f"__k{i}"])
    joined = rows.join(bins, same_bin, "left")
    out = [F.col(c) for c in df.columns]
    out += [(F.col(f"__l_{n}") + F.col(f"__c_{n}")).alias(n) for n in sums]
    for n in list(lags) + list(leads):
        here = F.col(f"__l_{n}")
        out.append(F.when(here.isNotNull(), here[f"__v_{n}"]).otherwise(F.col(f"__c_{n}")).alias(n))
    assert len(set(names)) == len(names), "output names must differ"
    return joined.select(*out)


def runs(df: DataFrame, keys: list[str], order: list, symbol: str, bins: int | None = None) -> DataFrame:
    """Run-length encode rows: ``keys, symbol, start, end`` (0-based half-open row positions inside a key).

    All keys lie in one order, so a run ends where the next one starts, whichever key that has, and its
    place inside the key is the distance from the key's first run.
    """
    if not keys:
        one = runs(df.withColumn("__all", F.lit(0)), ["__all"], order, symbol, bins)
        return one.drop("__all")
    placed = dealt(df.select(*keys, *dict.fromkeys(o for o in order if o not in keys), F.col(symbol).alias("__symbol")), [*keys, *order], bins, "runs")
    key = F.struct(*keys)
    steps = climb(placed.rows, placed.bins, sums={"__n": F.lit(1).cast("long")}, lags={"__before": F.struct(key.alias("k"), F.col("__symbol").alias("s"))})
    new_key = F.col("__before").isNull() | ~F.col("__before.k").eqNullSafe(key)
    heads = steps.withColumn("__head", new_key).filter(new_key | ~F.col("__before.s").eqNullSafe(F.col("__symbol")))
    ends = climb(heads, placed.bins, leads={"__next": F.col("__n")}, peaks={"__first": F.when(F.col("__head"), F.col("__n"))})
    total = placed.rows.agg(F.count(F.lit(1))).scalar()
    return ends.select(*keys, F.col("__symbol").alias("symbol"), (F.col("__n") - F.col("__first")).alias("start"),
                       (F.coalesce("__next", total) - F.col("__first")).alias("end"))
