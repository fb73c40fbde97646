"""Regex matches with positions, without leaving the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: preset patterns per motif kind -----------------------------
PRESETS = {
    "kex2_cutsite": ("[KR]R", "L[A-Z][A-Z]R", "[LIJVAP][A-Z][KRTPEI]R"),
    "rxlr_like_motif": ("[RKH][A-Z][LMIFYW][A-Z]",),
}
# --- end of fixed values ------------------------------------------------------

BLOCK = 64


def custom_pattern(regex: str) -> str:
    """User patterns ignore case; presets do not."""
    return f"(?i){regex}"


def match_spans(text: Column, regex: str) -> Column:
    """``array<struct<match, start, end>>`` of all non-overlapping matches, left to right.

    Matches and the text between them alternate, so the start of match *i* is the
    total length of everything before it.  The running offset is kept in two
    levels, over blocks of matches and inside each block: a text with a million
    matches stays affordable because no fold ever grows an array of that size
    one element at a time.
    """
    pieces = F.transform(
        F.filter(
            F.arrays_zip(
                F.regexp_extract_all(text, F.lit(regex), F.lit(0)).alias("m"),
                F.split(text, regex, -1).alias("b"),
            ),
            lambda p: p["m"].isNotNull(),
        ),
        lambda p: F.struct(
            p["m"].alias("match"),
            F.length(p["b"]).alias("gap"),
            (F.length(p["b"]) + F.length(p["m"])).alias("step"),
        ),
    )
    # the one-element outer transform binds the pieces once for the lambdas below
    return F.transform(F.array(pieces), _place_blocks)[0]


def _no_spans() -> Column:
    return F.expr("cast(array() as array<struct<match string, start int, end int>>)")


def _place_blocks(pieces: Column) -> Column:
    firsts = F.filter(F.transform(pieces, lambda _, i: i), lambda i: i % BLOCK == 0)
    blocks = F.transform(firsts, lambda first: _block(F.slice(pieces, first + 1, BLOCK)))
    return F.aggregate(
        blocks,
        F.struct(F.lit(0).alias("at"), F.array(_no_spans()).alias("out")),
        lambda acc, block: F.struct(
            (acc["at"] + block["total"]).alias("at"),
            F.concat(acc["out"], F.array(_place(acc["at"], block["part"]))).alias("out"),
        ),
        lambda acc: F.flatten(acc["out"]),
    )


def _block(part: Column) -> Column:
    total = F.aggregate(part, F.lit(0), lambda s, x: s + x["step"])
    return F.struct(part.alias("part"), total.alias("total"))


def _place(at: Column, part: Column) -> Column:
    return F.aggregate(
        part,
        F.struct(at.alias("at"), _no_spans().alias("out")),
        lambda a, x: F.struct(
            (a["at"] + x["step"]).alias("at"),
            F.concat(a["out"], F.array(F.struct(
                x["match"].alias("match"),
                (a["at"] + x["gap"]).alias("start"),
                (a["at"] + x["step"]).alias("end"),
            ))).alias("out"),
        ),
        lambda a: a["out"],
    )
