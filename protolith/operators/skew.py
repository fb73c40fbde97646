"""Joins that stay balanced when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 10_000


def lookup(left: DataFrame, right: DataFrame, key: str, copies: str, spread: Column) -> DataFrame:
    """Join many rows to the one ``right`` row of their key, in a single pass over ``left``.

    ``copies`` is a right column with the number of left rows per key.  A key is
    hot when it owns more than 1/10,000 of all rows, so there are fewer than
    10,000 hot keys however large the tables are: those are broadcast.  Rows that
    found their match this way, and rows without a key, travel the shuffle join under a key
    of their own (from ``spread``, anything that differs between rows) and stay balanced.
    Rows whose key is NULL come back with NULL values, rows with an unknown key do not.
    """
    columns = [c for c in right.columns if c not in (key, copies)]
    total = right.agg(F.sum(copies)).scalar()
    is_hot = F.col(copies) * HOT_SHARE > total
    value = F.struct(*columns)
    hot = right.filter(is_hot).select(key, value.alias("__hot"))
    cold = right.filter(~is_hot).select(F.col(key).alias("__key"), value.alias("__cold"))
    rows = left.join(F.broadcast(hot), key, "left").withColumn(
        "__key", F.when(F.col("__hot").isNull() & F.col(key).isNotNull(), F.col(key)).otherwise(
            F.concat(F.lit("\u0000"), F.xxhash64(spread).cast("string"))))
    joined = rows.join(cold, "__key", "left").withColumn("__v", F.coalesce("__hot", "__cold"))
    return joined.filter(F.col("__v").isNotNull() | F.col(key).isNull()).select(*left.columns, "__v.*")
