"""Connected components by joins: smallest label of the neighbours, then labels of labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from protolith.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges (a, b)``; the label is the smallest node it reaches.

    Every round takes the smallest label among the neighbours (pre-aggregated before the
    shuffle, so a node with very many links is no hot group) and then the label of that
    label, which halves long chains.  Ends when a round changes nothing.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = cut_lineage(both.distinct())
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label"))
    labels = cut_lineage(labels)
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), "label"), "b")
        best = seen.groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        hooked = labels.join(best, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        above = hooked.select(F.col("node").alias("label"), F.col("label").alias("up"))
        moved = hooked.join(above, "label").select("node", "old", F.least("label", "up").alias("label"))
        moved = cut_lineage(moved)
        changed = moved.filter(F.col("old") != F.col("label")).limit(1).count()
        labels = moved.select("node", "label")
        if not changed:
            return labels
