"""Per-residue label strings and segment notations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .motifs import match_spans


def runs(labels: Column, alphabet: str) -> Column:
    """``array<struct<symbol, start, end>>`` of equal neighbours, 0-based half-open.

    The alphabet is fixed per tool, so a run is a regex match: ``(M+|B+|...)``.
    """
    regex = "|".join(f"{'[.]' if c == '.' else c}+" for c in alphabet)
    return F.transform(
        match_spans(labels, regex),
        lambda m: F.struct(
            F.substring(m["match"], 1, 1).alias("symbol"),
            m["start"].alias("start"),
            m["end"].alias("end"),
        ),
    )


def longest_run(labels: Column, alphabet: str) -> Column:
    regex = "|".join(f"{c}+" for c in alphabet)
    lengths = F.transform(F.regexp_extract_all(labels, F.lit(regex), F.lit(0)), F.length)
    return F.coalesce(F.array_max(lengths), F.lit(0))


def signal_flag(labels: Column) -> Column:
    """More than 10 of the first 30 residues labelled as signal, case-folded."""
    head = F.lower(F.substring(labels, 1, 30))
    return F.length(F.regexp_replace(head, "[^s]", "")) > 10


def membrane_flag(labels: Column) -> Column:
    """Some membrane label runs for more than 10 residues."""
    return longest_run(labels, "BbHh") > 10


def membrane_segments(topology: Column) -> Column:
    """``array<struct<start,end>>`` of ``i5-27o40-60`` notation, 0-based half-open."""
    spans = F.regexp_extract_all(topology, F.lit(r"[io]\d+[-/]\d+"), F.lit(0))
    return F.transform(
        spans,
        lambda s: F.struct(
            (F.regexp_extract(s, r"(\d+)[-/]", 1).cast("int") - 1).alias("start"),
            F.regexp_extract(s, r"[-/](\d+)", 1).cast("int").alias("end"),
        ),
    )


def signal_regions(topology: Column) -> Column:
    """n-, h- and c-regions of ``n4-20c25/26`` notation, as ``array<struct<type,start,end>>``.

    The c-region runs from the end of the h-region to the number after ``c``.
    """
    def pos(i: int) -> Column:
        return F.regexp_extract(topology, r"n(\d+)[-/](\d+)(?:.*?c(\d+)[-/]\d+)?", i).try_cast("int")

    n_end, h_end, c_end = pos(1), pos(2), pos(3)
    regions = F.array(
        F.struct(F.lit("n_terminal_region").alias("type"), F.lit(0).alias("start"),
                 (n_end - 1).alias("end")),
        F.struct(F.lit("central_hydrophobic_region_of_signal_peptide").alias("type"),
                 (n_end - 1).alias("start"), h_end.alias("end")),
        F.struct(F.lit("c_terminal_region").alias("type"), h_end.alias("start"),
                 c_end.alias("end")),
    )
    return F.filter(regions, lambda r: r["start"] < r["end"])


def summary_text(labels: Column, alphabet: str = "BbHhS.", signal: str = "S", membrane: str = "BbHh") -> Column:
    """``sp:1-20|tm:25-45,60-80`` of a label string, 1-based; NULL when there is neither."""
    def listed(mark: str, symbols: str) -> Column:
        mine = F.filter(found, lambda r: r["symbol"].isin(*symbols))
        places = F.transform(mine, lambda r: F.concat((r["start"] + 1).cast("string"), F.lit("-"), r["end"].cast("string")))
        return F.when(F.size(mine) > 0, F.concat(F.lit(f"{mark}:"), F.array_join(places, ",")))

    found = runs(labels, alphabet)
    return F.nullif(F.concat_ws("|", listed("sp", signal), listed("tm", membrane)), F.lit(""))
