"""Ranked scores along the genome: one row per elementary coding segment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .intervals import BIN, bucket_bits, crowded, fold_buckets, fold_overlaps, segments
from .ordered import scan

# --- fixed values: numeric columns of the ranked table ---------------------------
NUMERIC_COLUMNS = (
    "effector_score", "manual_effector_score", "manual_secretion_score", "effectorp1", "effectorp2",
    "effectorp3_cytoplasmic", "effectorp3_apoplastic", "effectorp3_noneffector", "deepredeff_fungi",
    "deepredeff_oomycete", "apoplastp", "molecular_weight", "residue_number", "charge",
    "isoelectric_point", "aa_c_number", "aa_tiny_number", "aa_small_number", "aa_aliphatic_number",
    "aa_aromatic_number", "aa_nonpolar_number", "aa_charged_number", "aa_basic_number",
    "aa_acidic_number", "fykin_gap", "targetp_secreted_prob", "targetp_mitochondrial_prob",
    "deeploc_membrane", "deeploc_nucleus", "deeploc_cytoplasm", "deeploc_extracellular",
    "deeploc_mitochondrion", "deeploc_cell_membrane", "deeploc_endoplasmic_reticulum",
    "deeploc_plastid", "deeploc_golgi", "deeploc_lysosome", "deeploc_peroxisome", "signalp3_nn_d",
    "signalp3_hmm_s", "signalp4_d", "signalp5_prob", "signalp6_prob", "deepsig_signal_prob",
    "deepsig_transmembrane_prob", "deepsig_other_prob",
)
# --- end of fixed values ------------------------------------------------------


def numeric_subset(ranked: DataFrame, targets: list[str] | None = None, name: str = "name") -> DataFrame:
    """The name and the wanted numeric columns; an unknown target is an error."""
    wanted = list(NUMERIC_COLUMNS) if targets is None else targets
    unknown = [t for t in wanted if t not in NUMERIC_COLUMNS]
    if unknown:
        raise ValueError(f"not numeric columns: {', '.join(unknown)}")
    return ranked.select(name, *wanted)


def merge_spans(spans: DataFrame, keys: list[str], start: str, end: str, bin_size: int = BIN) -> DataFrame:
    """Union of overlapping or touching intervals per key.

    Depth is a running sum of +1 at starts and -1 at ends, so a key with many
    intervals is scanned in bins.
    """
    steps = spans.filter(F.col(start) < F.col(end)).select(*keys, F.inline(F.array(
        F.struct(F.col(start).cast("bigint").alias("__p"), F.lit(1).cast("bigint").alias("__d")),
        F.struct(F.col(end).cast("bigint").alias("__p"), F.lit(-1).cast("bigint").alias("__d")))))
    net = steps.groupBy(*keys, "__p").agg(F.sum("__d").alias("__d")).filter(F.col("__d") != 0)
    depth = scan(net, keys, F.floor(F.col("__p") / bin_size), ["__p"], sums={"__before": F.col("__d")})
    edges = depth.filter((F.col("__before") == 0) | (F.col("__before") + F.col("__d") == 0))
    paired = scan(edges, keys, F.floor(F.col("__p") / bin_size), ["__p"], leads={"__e": F.col("__p")})
    return paired.filter(F.col("__before") == 0).select(
        *keys, F.col("__p").alias(start), F.col("__e").alias(end))


def scores_to_genome(
    exons: DataFrame, scores: DataFrame, columns: list[str], reducer: str = "max", name: str = "name",
) -> DataFrame:
    """Fold scores over the proteins that cover each segment: ``seqid, start, end, *columns``.

    ``exons`` holds ``id, seqid, start, end``.  Exons of proteins without scores cut
    segments but score nothing, and a protein counts once per segment however
    many of its exons cover it.
    """
    known = scores.select(F.col(name).alias("id"), *columns)
    spans = exons.select("id", "seqid", "start", "end")
    bits = bucket_bits(spans, "start", "end")
    busy = crowded(spans, "seqid", "start", "end", bits, reducer)
    if busy.isEmpty():
        return _fold_in_place(spans, known, columns, reducer, bits)
    return _fold_in_place(spans.join(busy, "seqid", "left_anti"), known, columns, reducer, bits).unionByName(
        _fold_apart(spans.join(busy, "seqid", "left_semi"), known, columns, reducer))


def _fold_in_place(spans: DataFrame, known: DataFrame, columns: list[str], reducer: str, bits: int) -> DataFrame:
    """Spans and scores meet once, then each bucket of a sequence is folded by itself."""
    return fold_buckets(spans.join(known.withColumn("once", F.monotonically_increasing_id()), "id", "left"), columns, reducer, bits)


def _fold_apart(spans: DataFrame, known: DataFrame, columns: list[str], reducer: str) -> DataFrame:
    """Sequences with more spans in one place than a task should hold."""
    cut = segments(spans, "seqid", "start", "end")
    if reducer in ("mean", "median"):
        # least and greatest do not care about repeats
        spans = merge_spans(spans, ["seqid", "id"], "start", "end")
    return fold_overlaps(spans.join(known, "id"), "seqid", "start", "end", columns, reducer, cut)
