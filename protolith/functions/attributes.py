"""Feature attributes: one struct, its text form, and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bound, by_line_ends, escape, strip, unescape

# --- fixed values: reserved attribute keys, in write order ---------------------
RESERVED = (
    ("ID", "id"), ("Name", "name"), ("Alias", "alias"), ("Parent", "parent"),
    ("Target", "target"), ("Gap", "gap"), ("Derives_from", "derives_from"), ("Note", "note"),
    ("Dbxref", "dbxref"), ("Ontology_term", "ontology_term"), ("Is_circular", "is_circular"),
)
# --- end of fixed values ------------------------------------------------------

TARGET = "struct<id: string, start: int, end: int, strand: string>"
GAP = "array<struct<code: string, length: int>>"
ATTRIBUTES = (
    "struct<id: string, name: string, alias: array<string>, parent: array<string>, "
    f"target: {TARGET}, gap: {GAP}, derives_from: array<string>, note: array<string>, "
    "dbxref: array<string>, ontology_term: array<string>, is_circular: boolean, "
    "custom: map<string, array<string>>>"
)
FEATURE = (
    "struct<seqid: string, source: string, type: string, start: int, end: int, score: double, "
    f"strand: string, phase: string, attributes: {ATTRIBUTES}>"
)
TYPES = {
    "id": "string", "name": "string", "alias": "array<string>", "parent": "array<string>",
    "target": TARGET, "gap": GAP, "derives_from": "array<string>", "note": "array<string>",
    "dbxref": "array<string>", "ontology_term": "array<string>", "is_circular": "boolean",
    "custom": "map<string, array<string>>",
}


def attributes(**given: Column) -> Column:
    """An attribute struct; fields that are not given are NULL."""
    unknown = set(given) - set(TYPES)
    if unknown:
        raise ValueError(f"unknown attributes {sorted(unknown)}")
    return F.struct(*[
        given.get(k, F.lit(None)).cast(t).alias(k) if k not in given or not t.startswith(("struct", "map"))
        else given[k].alias(k) for k, t in TYPES.items()])


def target(id_: Column, start: Column, end: Column, strand: Column | None = None) -> Column:
    side = F.lit(None).cast("string") if strand is None else strand
    return F.struct(id_.alias("id"), start.cast("int").alias("start"),
                    end.cast("int").alias("end"), side.alias("strand"))


def custom_from(pairs: list[tuple[str, Column]]) -> Column:
    """A map of one-element lists; NULL values are left out."""
    return custom_lists([k for k, _ in pairs], F.array(*[v.cast("string") for _, v in pairs]))


def custom_lists(keys: list[str], values: Column) -> Column:
    """The same from one array of texts."""
    names = F.split(F.lit(",".join(keys)), ",")
    entries = F.zip_with(names, values, lambda k, v: F.struct(k.alias("key"), F.array(v).alias("value")))
    return F.map_from_entries(F.filter(entries, lambda e: e["value"][0].isNotNull()))


def gap_from_cigar(cigar: Column) -> Column:
    found = F.regexp_extract_all(cigar, F.lit(r"\d+[MIDFR]"), F.lit(0))
    return F.transform(found, lambda p: F.struct(
        F.regexp_extract(p, r"([MIDFR])$", 1).alias("code"),
        F.regexp_extract(p, r"^(\d+)", 1).cast("int").alias("length")))


def parse_gap(text: Column) -> Column:
    found = F.filter(F.split(strip(text), " "), lambda p: p != "")
    return F.transform(found, lambda p: F.struct(
        F.substring(p, 1, 1).alias("code"), F.substring(p, 2, 20).try_cast("int").alias("length")))


def gap_text(gap: Column) -> Column:
    return F.array_join(F.transform(gap, lambda g: F.concat(g["code"], g["length"].cast("string"))), " ")


def parse_target(text: Column) -> Column:
    """``id start end [strand]``, start 1-based in the text and 0-based in the struct."""
    def build(parts: Column) -> Column:
        size = F.size(parts)
        return F.when(size.between(3, 4), target(
            F.replace(unescape(F.get(parts, F.lit(0))), F.lit("%20"), F.lit(" ")),
            F.get(parts, F.lit(1)).try_cast("int") - 1, F.get(parts, F.lit(2)).try_cast("int"),
            F.get(parts, F.lit(3))))
    return F.when(text.isNotNull(), bound(F.split(strip(text), " "), build))


def target_text(t: Column) -> Column:
    return F.when(t.isNotNull(), F.concat_ws(
        " ", F.replace(escape(t["id"]), F.lit(" "), F.lit("%20")),
        (t["start"] + 1).cast("string"), t["end"].cast("string"), t["strand"]))


def _parse_list(value: Column) -> Column:
    def parts(trim) -> Column:
        return F.transform(F.split(trim(value, ", "), ","), lambda p: unescape(trim(p)))
    return F.when(F.coalesce(value, F.lit("")) != "", by_line_ends(value, parts))


def parse_attributes(text: Column, strip_quote: bool = False) -> Column:
    """Attribute text to struct; an empty column or ``.`` gives a struct of NULLs."""
    return bound(attribute_pairs(text, strip_quote), attributes_from)


def attribute_pairs(text: Column, strip_quote: bool = False) -> Column:
    """Attribute text to a map of keys and their texts."""
    def pairs(trim) -> Column:
        fields = F.filter(F.split(trim(F.coalesce(text, F.lit("")), " ;"), ";"), lambda f: f.contains("="))
        entries = F.transform(fields, lambda f: F.struct(
            trim(F.substring_index(f, "=", 1)).alias("key"),
            trim(f.substr(F.instr(f, "=") + 1, F.length(f)), *([" '\""] if strip_quote else [])).alias("value")))
        return bound(entries, _last_of_each)
    return by_line_ends(text, pairs)


def _last_of_each(entries: Column) -> Column:
    """Key to value; of a repeated key the last one counts."""
    keys = F.transform(entries, lambda e: e["key"])
    unique = F.size(F.array_distinct(keys)) == F.size(entries)
    last = F.filter(entries, lambda e, i: ~F.exists(
        F.slice(entries, i + 2, F.greatest(F.size(entries), F.lit(1))), lambda later: later["key"] == e["key"]))
    return F.map_from_entries(F.when(unique, entries).otherwise(last))


def attributes_from(pairs: Column) -> Column:
    """The attribute struct of a map of keys and texts; ``pairs`` is used often, so it should be a column."""
    def get(key: str) -> Column:
        return F.try_element_at(pairs, F.lit(key))

    reserved = F.array(*[F.lit(k) for k, _ in RESERVED])
    rest = F.map_filter(pairs, lambda k, v: ~F.array_contains(reserved, k) & (v != ""))
    values = F.transform_values(
        rest, lambda _, v: F.when(v.contains(","), _parse_list(v)).otherwise(F.array(v)))
    return attributes(
        id=F.nullif(unescape(get("ID")), F.lit("")), name=F.nullif(unescape(get("Name")), F.lit("")),
        alias=_parse_list(get("Alias")), parent=_parse_list(get("Parent")),
        target=parse_target(get("Target")),
        gap=F.when(get("Gap").isNotNull(), parse_gap(get("Gap"))),
        derives_from=_parse_list(get("Derives_from")), note=_parse_list(get("Note")),
        dbxref=_parse_list(get("Dbxref")), ontology_term=_parse_list(get("Ontology_term")),
        is_circular=F.coalesce(F.lower(get("Is_circular")) == "true", F.lit(False)), custom=values,
    )


def attributes_text(a: Column) -> Column:
    """Reserved keys in fixed order, then the custom ones; ``.`` when there is nothing."""
    def listed(values: Column) -> Column:
        return F.array_join(F.transform(values, escape), ",")

    parts = []
    for key, name in RESERVED:
        value = a[name]
        if name in ("id", "name"):
            shown = escape(value)
        elif name == "target":
            shown = escape(target_text(value))
        elif name == "gap":
            shown = F.when(F.size(value) > 0, escape(gap_text(value)))
        elif name == "is_circular":
            shown = F.when(value, F.lit("true"))
        else:
            shown = F.when(F.size(value) > 0, listed(value))
        parts.append(F.concat(F.lit(f"{key}="), shown))
    extra = F.transform(
        F.filter(F.map_entries(a["custom"]), lambda e: F.size(e["value"]) > 0),
        lambda e: F.concat(escape(e["key"]), F.lit("="), listed(e["value"])))
    text = F.concat_ws(";", *parts, F.array_join(F.coalesce(extra, F.array().cast("array<string>")), ";"))
    return F.coalesce(F.nullif(F.rtrim(text, F.lit(";")), F.lit("")), F.lit("."))
