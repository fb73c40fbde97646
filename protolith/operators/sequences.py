"""Sequence normalising, checksums, de-duplication and chunking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.checksums import encode_id, sequence_checksum, sequence_md5
from ..functions.motifs import PRESETS, custom_pattern, match_spans
from ..session import stored
from .ordered import number_rows
from .skew import lookup


def normalise(seq: Column) -> Column:
    """Drop gaps, strip trailing stops, upper-case, and mask ambiguous letters as X."""
    bare = F.rtrim(F.regexp_replace(seq, "[-.]", ""), F.lit("*"))
    return F.translate(F.upper(bare), "*JBZUO", "XXXXXX")


def invalid(seq: Column, strict: bool = False) -> Column:
    """Contains a non-letter.  By default only the first character is tested."""
    return seq.rlike("[^A-Za-z]" if strict else "^[^A-Za-z]")


def with_checksums(df: DataFrame, seq: str = "seq") -> DataFrame:
    return df.withColumn("checksum", sequence_checksum(F.col(seq))).withColumn(
        "md5sum", sequence_md5(F.col(seq)))


def dedup_encode(
    df: DataFrame, order: list[str], seq: str = "seq", prefix: str = "SR", length: int = 5, bins: int | None = None
) -> DataFrame:
    """Give every distinct sequence a short id, numbered by first occurrence.

    All input rows come back with ``encoded, checksum, md5sum``; the ids of
    duplicates are shared.  ``order`` names columns.  Rows without a sequence come back without id and checksums, and
    take no number.  Sequences are normalised and hashed once, into a written table.
    """
    rows = stored(with_checksums(df.withColumn(seq, normalise(F.col(seq))), seq), "checksums")
    # one plain order column keeps the aggregate hashed
    earliest = F.min(order[0] if len(order) == 1 else F.struct(*order)).alias("__first")
    first = rows.filter(F.col("checksum").isNotNull()).groupBy("checksum").agg(earliest, F.count(F.lit(1)).alias("__copies"))
    back = [F.col("__first").alias(order[0])] if len(order) == 1 else [F.col("__first.*")]
    first = first.select("checksum", "__copies", *back)
    codes = stored(number_rows(first, order, out="__n", bins=bins).select(
        "checksum", "__copies", encode_id(F.col("__n"), prefix, length).alias("encoded")), "codes")
    return lookup(rows, codes, "checksum", "__copies", F.struct(*order))


def distinct_sequences(encoded: DataFrame, seq: str = "seq") -> DataFrame:
    """The records a de-duplicated FASTA holds: one per id."""
    return encoded.groupBy("encoded").agg(F.min(seq).alias(seq))


def chunk(df: DataFrame, order: list, size: int = 1000, bins: int | None = None) -> DataFrame:
    """Consecutive chunks of ``size`` rows, numbered from 1."""
    numbered = number_rows(df, order, out="__n", bins=bins)
    return numbered.withColumn("chunk", (F.floor(F.col("__n") / size) + 1).cast("bigint")).drop("__n")


def _labelled(spans: Column, pattern: str) -> Column:
    return F.transform(spans, lambda m: F.struct(
        F.lit(pattern).alias("pattern"), m["match"].alias("match"),
        m["start"].alias("start"), m["end"].alias("end")))


def scan_motifs(
    df: DataFrame, kind: str, regex: str | None = None, seq: str = "seq", name: str = "id"
) -> DataFrame:
    """Every non-overlapping match: ``name, kind, pattern, match, start, end``.

    Preset kinds bring their own patterns; ``custom`` needs one, ignores case and
    may not match the empty string.
    """
    if kind == "custom":
        if not regex:
            raise ValueError("a custom scan needs a regex")
        patterns = {regex: custom_pattern(regex)}
    elif kind in PRESETS:
        patterns = {p: p for p in PRESETS[kind]}
    else:
        raise ValueError(f"unknown motif kind {kind}")
    found = [_labelled(match_spans(F.col(seq), regex_), shown) for shown, regex_ in patterns.items()]
    hits = df.select(F.col(name).alias("name"), F.inline(F.concat(*found) if len(found) > 1 else found[0]))
    return hits.select("name", F.lit(kind).alias("kind"), "pattern", "match", "start", "end")
