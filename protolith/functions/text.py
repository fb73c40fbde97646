"""String helpers shared by readers, writers and feature rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: reserved characters of feature attributes, escape order ----
ESCAPES = (
    ("%", "%25"), (";", "%3B"), (",", "%2C"), ("=", "%3D"),
    ("\t", "%09"), ("\n", "%0A"), ("\r", "%0D"),
)
# --- end of fixed values ------------------------------------------------------


def bound(value: Column, fn) -> Column:
    """``fn(value)`` with ``value`` evaluated once, however often ``fn`` uses it."""
    return F.transform(F.array(value), fn)[0]


def escape(col: Column) -> Column:
    """Percent-escape; the percent sign itself goes first."""
    done = reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), ESCAPES, col)
    return F.when(col.rlike("[%;,=\\t\\n\\r]"), done).otherwise(col)


def unescape(col: Column) -> Column:
    """Undo :func:`escape`; the percent sign goes last."""
    order = ESCAPES[1:] + ESCAPES[:1]
    done = reduce(lambda c, p: F.replace(c, F.lit(p[1]), F.lit(p[0])), order, col)
    return F.when(col.contains("%"), done).otherwise(col)


def strip(col: Column) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.regexp_replace(col, r"^\s+|\s+$", "")


LINE_ENDS = "\n\r\u0085\u2028\u2029"
WHITE = " \t\n\x0b\f\r"


def bare(col: Column, chars: str = WHITE) -> Column:
    """:func:`trimmed` of a text without line ends."""
    return F.btrim(col, F.lit(chars))


def trimmed(col: Column, chars: str = WHITE) -> Column:
    """Remove leading and trailing characters of a set: ``^[chars]+|[chars]+$`` without trying every place of the text.

    Only a regex sees what stands before a closing line end that is not in the set.
    """
    ends = [c for c in LINE_ENDS if c not in chars]
    return F.when(F.substring(col, -1, 1).isin(*ends), F.regexp_replace(col, f"^[{chars}]+|[{chars}]+$", "")).otherwise(bare(col, chars))


def by_line_ends(text: Column, fn) -> Column:
    """``fn(trim)`` with the quicker trim for a text without line ends."""
    return F.when(text.rlike(f"[{LINE_ENDS}]"), fn(trimmed)).otherwise(fn(bare))


def before_last(col: Column, sep: str) -> Column:
    """The part before the last separator, or the whole string without one."""
    return F.regexp_replace(col, f"{sep}[^{sep}]*$", "")


def key_value(col: Column, key: str) -> Column:
    """The value of ``key=value``; NULL when the key differs."""
    return F.when(col.startswith(f"{key}="), F.substring(col, len(key) + 2, 2147483647))


def matched(col: Column, regex: str, group: int) -> Column:
    """A regex group, NULL (not empty) when nothing matched."""
    return F.nullif(F.regexp_extract(col, regex, group), F.lit(""))


def number_text(col: Column) -> Column:
    """A double as the shortest plain text: 12.5, 0.0001, 1e-05, 1.2e-30."""
    raw = col.cast("string")
    mantissa = F.regexp_replace(F.regexp_extract(raw, r"^(-?[0-9.]+)E", 1), r"\.0$", "")
    power = F.regexp_extract(raw, r"E(-?\d+)$", 1).try_cast("int")
    digits = F.replace(F.replace(mantissa, F.lit(".")), F.lit("-"))
    sign = F.when(mantissa.startswith("-"), "-").otherwise("")
    size = F.abs(power).cast("string")
    scientific = F.concat(
        mantissa,
        F.when(power < 0, "e-").otherwise("e+"),
        F.when(F.length(size) < 2, F.lpad(size, 2, "0")).otherwise(size),
    )
    plain_large = F.concat(
        sign, F.rpad(F.substring(digits, 1, 32), power + 1, "0").substr(F.lit(1), power + 1),
        F.lit("."),
        F.when(F.length(digits) > power + 1, digits.substr(power + 2, F.lit(32))).otherwise("0"),
    )
    return (
        F.when(~raw.contains("E"), raw)
        .when(power.isNull(), raw)
        .when(power == -4, F.concat(sign, F.lit("0.000"), digits))
        .when(power.between(7, 15), plain_large)
        .otherwise(scientific)
    )


def flag_text(col: Column) -> Column:
    return F.when(col, "true").otherwise("false")


def source_tag(software, version, database=None, database_version=None) -> Column:
    """``software:version:database:dbversion`` with the NULL parts left out."""
    parts = [p for p in (software, version, database, database_version) if p is not None]
    return F.concat_ws(":", *parts)


def cut_site(text: Column) -> Column:
    """A predicted cut site ``CS pos [kind]: 22-23. [residues.] Pr: 0.9`` as ``kind, next, words, prob``; NULL if it is none.

    ``kind`` is what stands between ``pos`` and the colon, ``next`` the position behind the cut and
    ``words`` the number of words between the colon and ``Pr:``.
    """
    before, after = F.substring_index(text, "Pr:", 1), F.substring_index(text, "Pr:", -1)
    label, body = F.trim(F.substring_index(before, ":", 1)), F.trim(F.substring_index(before, ":", -1))
    words = F.split(body, r"\s+")
    ends = F.split(F.translate(F.get(words, F.lit(0)), ".", ""), "-")
    prob = F.get(F.split(F.trim(after), r"\s+"), F.lit(0))
    following = F.get(ends, F.lit(1)).try_cast("int")
    fits = (text.contains("Pr:") & label.startswith("CS") & F.ltrim(F.substring(label, 3, 100)).startswith("pos")
            & F.get(ends, F.lit(0)).try_cast("int").isNotNull() & following.isNotNull() & prob.try_cast("double").isNotNull())
    kind = F.trim(F.substring(F.ltrim(F.substring(label, 3, 100)), 4, 100))
    return F.when(fits, F.struct(kind.alias("kind"), following.alias("next"), F.size(words).alias("words"), prob.alias("prob")))


def cut_position(text: Column, words: int) -> Column:
    """The position behind the cut of a site without kind that has so many words ahead of ``Pr:``."""
    site = cut_site(text)
    return F.when((site["kind"] == "") & (site["words"] == words), site["next"])
