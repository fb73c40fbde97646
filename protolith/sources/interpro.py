"""Protein match XML to interval features.

Each protein is one row with only the elements named in the schema; every match
kind is a rule over its array of matches, so a protein is parsed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.attributes import FEATURE, attributes, custom_from, target
from ..functions.text import bound, source_tag, unescape
from ..session import stored

#: Files whose versions may be broadcast, and copies of a longer list.
SMALL, COPIES = 100_000, 64
BROKEN = "_corrupt_record"

_XREFS = "array<struct<_db: string, _id: string>>"
_GO = "array<struct<_id: string, _name: string>>"
_ENTRY = (
    "struct<_ac: string, _desc: string, _name: string, _type: string, "
    f"`pathway-xref`: {_XREFS}, `go-xref`: {_GO}>"
)
SIGNATURE = (
    "struct<_ac: string, _desc: string, _name: string, "
    f"entry: array<{_ENTRY}>, `signature-library-release`: struct<_library: string, _version: string>>"
)


def _struct(names: str, extra: str = "") -> str:
    fields = [f"`_{n}`: string" for n in names.split()] + ([extra] if extra else [])
    return f"struct<{', '.join(fields)}>"


def _fragments(kind: str) -> str:
    part = _struct("start end")
    return f"`location-fragments`: struct<`{kind}-location-fragment`: array<{part}>>"


_SITE_PLACES = f"`site-locations`: struct<`site-location`: array<{_struct('start end residue')}>>"
_PLAIN_SITES = f"array<struct<_description: string, {_SITE_PLACES}>>"
_MODEL_SITES = f"array<struct<_description: string, hmmStart: string, hmmEnd: string, {_SITE_PLACES}>>"

# --- fixed values: match kinds, and the attributes each one carries -----------------
HMM_LOCATION = "start end env-start env-end hmm-start hmm-end hmm-bounds"
LOCATIONS = {
    "coils": _struct("start end", _fragments("coils")),
    "tmhmm": _struct("start end", _fragments("tmhmm")),
    "signalp": _struct("start end score", _fragments("signalp")),
    "mobidblite": _struct("start end", _fragments("mobidblite")),
    "hmmer3": _struct(HMM_LOCATION),
    "panther": _struct(HMM_LOCATION),
    "hmmer2": _struct("start end hmm-start hmm-end hmm-bounds"),
    "profilescan": _struct("start end score"),
    "rpsblast": _struct("start end score evalue", (
        f"sites: struct<`rpsblast-site`: {_PLAIN_SITES}>")),
    "superfamilyhmmer3": _struct("start end"),
    "fingerprints": _struct("start end pvalue score"),
    "hmmer3-with-sites": _struct(HMM_LOCATION, (
        f"sites: struct<`hmmer3-site`: {_MODEL_SITES}>")),
    "patternscan": _struct("start end level"),
}
MATCH_ATTRIBUTES = {
    "hmmer3": ("score", "evalue"), "hmmer2": ("score", "evalue"), "panther": ("score", "evalue", "familyName"),
    "profilescan": ("score",), "superfamilyhmmer3": ("evalue",), "hmmer3-with-sites": ("score", "evalue"),
}
UNNAMED = ("Not available", "FAMILY NOT NAMED")
REGION_TYPES = {
    "coils": ("peptide_coil", "Coiled-coil"),
    "tmhmm": ("transmembrane_polypeptide_region", None),
    "mobidblite": ("intrinsically_unstructured_polypeptide_region", "consensus disorder prediction"),
}
# --- end of fixed values ------------------------------------------------------


def _match_name(kind: str) -> str:
    return "hmmer3-match-with-sites" if kind == "hmmer3-with-sites" else f"{kind}-match"


def _location_name(kind: str) -> str:
    return "hmmer3-location-with-sites" if kind == "hmmer3-with-sites" else f"{kind}-location"


def _match_type(kind: str) -> str:
    own = [f"`_{n}`: string" for n in MATCH_ATTRIBUTES.get(kind, ())]
    fields = [*own, f"signature: {SIGNATURE}",
              f"locations: struct<`{_location_name(kind)}`: array<{LOCATIONS[kind]}>>"]
    return f"array<struct<{', '.join(fields)}>>"


def protein_schema() -> str:
    kinds = ", ".join(f"`{_match_name(k)}`: {_match_type(k)}" for k in LOCATIONS)
    return f"xref array<struct<_id: string>>, matches struct<{kinds}>"


def read_proteins(spark: SparkSession, paths: str, version: str | None = None) -> DataFrame:
    """Proteins of match files: their elements, ``ips_version`` and ``problem``, with the text of broken ones.

    The closing tag is the record separator, so one large file is read by many
    tasks.  Without ``version``, the scanner version in each file's root element is
    used; proteins of a file without one have none.
    """
    raw = spark.read.option("lineSep", "</protein>").text(paths).withColumn(
        "file_path", F.col("_metadata.file_path"))
    found = F.regexp_extract("value", 'interproscan-version="([^"]+)"', 1)
    records = raw.withColumn("value", F.concat(
        F.regexp_extract("value", r"(?s)(<protein[ >].*)$", 1), F.lit("</protein>"))
    ).filter(F.col("value") != "</protein>")
    if version is not None:
        return parse_proteins(records, F.lit(version))
    # one row per file: few files travel to the records, a long list of files meets them in copies
    versions = stored(raw.select("file_path", found.alias("ips_version")).filter("ips_version <> ''").groupBy("file_path").agg(
        F.min("ips_version").alias("ips_version")), "file-versions")
    if versions.count() <= SMALL:
        return parse_proteins(records.join(F.broadcast(versions), "file_path", "left"), F.col("ips_version"))
    spread = versions.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    dealt = records.withColumn("copy", F.pmod(F.hash("value"), F.lit(COPIES)))
    return parse_proteins(dealt.join(spread, ["file_path", "copy"], "left"), F.col("ips_version"))


def parse_proteins(rows: DataFrame, version: Column, column: str = "value") -> DataFrame:
    """The same from a column that holds one protein element per row."""
    kind = T.StructType.fromDDL(protein_schema()).add(BROKEN, "string")
    parsed = F.from_xml(column, kind, {"attributePrefix": "_", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN})
    # a generator keeps each use from parsing again
    once = rows.select(F.col(column).alias("__text"), version.alias("ips_version"), F.inline(F.array(F.struct(parsed.alias("__p")))))
    broken = F.col("__p").isNull() | F.col(f"__p.{BROKEN}").isNotNull()
    problem = F.when(broken, "xml").when(F.coalesce(F.size("__p.xref"), F.lit(0)) < 1, "xref")
    return once.select(F.col("__p.xref").alias("xref"), F.col("__p.matches").alias("matches"), "ips_version", problem.alias("problem"),
                       F.when(problem.isNotNull(), F.col("__text")).alias("value"))


def bad_proteins(proteins: DataFrame) -> DataFrame:
    """Elements that cannot be used, as they came: ``value, problem`` and the version of their file."""
    return proteins.filter("problem IS NOT NULL").select("value", "problem", "ips_version")


def _signature(s: Column) -> dict[str, Column]:
    """Accession, name, description and cross references, entry values filling gaps."""
    entries = F.coalesce(s["entry"], F.expr(f"cast(array() as array<{_ENTRY}>)"))

    def first(field: str) -> Column:
        return F.get(F.filter(F.transform(entries, lambda e: e[field]), lambda v: v.isNotNull()), F.lit(0))

    def links(e: Column) -> Column:
        ac = F.when(e["_ac"].startswith("IPR"), F.concat(F.lit("InterPro:"), e["_ac"])).otherwise(e["_ac"])
        paths = F.coalesce(e["pathway-xref"], F.expr(f"cast(array() as {_XREFS})"))
        return F.concat(F.array(ac), F.transform(paths, lambda x: F.concat_ws(":", x["_db"], x["_id"])))

    def terms(e: Column) -> Column:
        go = F.coalesce(e["go-xref"], F.expr(f"cast(array() as {_GO})"))
        return F.flatten(F.transform(go, lambda g: F.filter(F.array(
            g["_id"], F.when(F.coalesce(g["_name"], F.lit("")) != "", F.concat(
                F.lit("GO:"), F.replace(g["_name"], F.lit(" "), F.lit("_"))))), lambda t: t.isNotNull())))

    own_name = F.when(s["_name"] != "FAMILY NOT NAMED", s["_name"])
    library = s["signature-library-release"]
    clean = lambda c: F.nullif(F.trim(unescape(c)), F.lit(""))
    return {
        "accession": unescape(s["_ac"]), "name": clean(F.coalesce(own_name, first("_name"))),
        "description": clean(F.coalesce(s["_desc"], first("_desc"))),
        "kind": clean(first("_type")), "library": unescape(library["_library"]),
        "library_version": unescape(library["_version"]),
        "dbxref": F.flatten(F.transform(entries, links)),
        "ontology_term": F.flatten(F.transform(entries, terms)),
    }


# A rule turns one match ``m`` with its signature fields ``s`` into an array of features.
PIECE = FEATURE.replace("seqid: string, source: string, ", "").removesuffix(">") + ", problem: string>"


def _row(type_: str, start: Column, end: Column, score: Column | None, attrs: Column) -> Column:
    given = F.lit(None).cast("string") if score is None else score
    first, last, value = start.try_cast("int"), end.try_cast("int"), given.try_cast("double")
    problem = F.when(first.isNull(), "start").when(last.isNull(), "end").when(given.isNotNull() & value.isNull(), "score")
    return F.struct(
        F.lit(type_).alias("type"), (first - 1).alias("start"), last.alias("end"), value.alias("score"),
        F.lit("+").alias("strand"), F.lit(".").alias("phase"), attrs.alias("attributes"), problem.alias("problem"))


def _last_fragment(location: Column, kind: str) -> Column:
    return F.element_at(location["location-fragments"][f"{kind}-location-fragment"], -1)


def _region(kind: str):
    """Coils, membrane and disorder: the last fragment of the last location."""
    type_, note = REGION_TYPES[kind]

    def rule(m: Column, s: Column, locs: Column) -> Column:
        part = _last_fragment(F.element_at(locs, -1), kind)
        attrs = attributes(note=F.array(F.lit(note))) if note else attributes()
        return F.array(_row(type_, part["_start"], part["_end"], None, attrs))
    return rule


def _signalp(m: Column, s: Column, locs: Column) -> Column:
    last = F.element_at(locs, -1)
    part = _last_fragment(last, "signalp")
    attrs = attributes(custom=custom_from([("model", s["library"])]))
    return F.array(_row("signal_peptide", part["_start"], part["_end"], last["_score"], attrs))


def _attributes_of(s: Column, custom: list, name: Column | None = None, aim: Column | None = None) -> Column:
    given = {"name": s["name"] if name is None else name, "dbxref": s["dbxref"],
             "ontology_term": s["ontology_term"], "custom": custom_from(custom)}
    if aim is not None:
        given["target"] = aim
    return attributes(**given)


def _described(s: Column, kind_default: str | None = None) -> list:
    kind = F.coalesce(s["kind"], F.lit(kind_default)) if kind_default else s["kind"]
    return [("description", s["description"]), ("kind", kind)]


def _sites(s: Column, sites: Column, place, custom) -> Column:
    note = F.when(s["name"].isNotNull(), F.array(F.concat(F.lit("Part of "), s["name"])))
    return F.transform(sites, lambda x: _row(
        "biochemical_region_of_peptide", place(x)["_start"], place(x)["_end"], None,
        attributes(note=note, custom=custom_from([("kind", F.lit("ACT_SITE")), *custom(x)]))))


def _model_match(kind: str):
    """Profile hits: model and envelope coordinates, with a target when the model span is known."""
    def rule(m: Column, s: Column, locs: Column) -> Column:
        last = F.element_at(locs, -1)
        known = last["_hmm-end"].try_cast("int") > 1
        names = [n for n in ("hmm-start", "hmm-end", "env-start", "env-end")
                 if not (kind == "hmmer2" and n.startswith("env"))]
        spans = [(n.replace("-", "_"), F.when(known, last[f"_{n}"])) for n in names]
        custom = [
            ("evalue", m["_evalue"]), ("score", m["_score"]), ("accession", s["accession"]),
            ("complete", F.when(last["_hmm-bounds"] == "COMPLETE", "true")),
            *_described(s, "FAMILY" if kind == "panther" else None), *spans]
        name = s["name"]
        if kind == "panther":
            name = F.coalesce(name, F.when(~m["_familyName"].isin(*UNNAMED), m["_familyName"]))
        aim = F.when(known, target(
            s["accession"], last["_hmm-start"].try_cast("int") - 1, last["_hmm-end"].try_cast("int")))
        main = F.array(_row("protein_hmm_match", last["_start"], last["_end"], m["_evalue"],
                            _attributes_of(s, custom, name, aim)))
        if kind != "hmmer3-with-sites":
            return main
        sites = F.flatten(F.transform(locs, lambda x: F.coalesce(
            x["sites"]["hmmer3-site"], F.expr(f"cast(array() as {_MODEL_SITES})"))))
        return F.concat(main, _sites(
            s, sites, lambda x: F.element_at(x["site-locations"]["site-location"], -1),
            lambda x: [("residue", F.element_at(x["site-locations"]["site-location"], -1)["_residue"]),
                       ("hmm_start", x["hmmStart"]), ("hmm_end", x["hmmEnd"]),
                       ("description", unescape(x["_description"]))]))
    return rule


def _profile_scan(m: Column, s: Column, locs: Column) -> Column:
    last = F.element_at(locs, -1)
    scores = F.filter(F.transform(locs, lambda x: x["_score"]), lambda v: v.isNotNull())
    score = F.coalesce(m["_score"], F.get(scores, F.lit(0)))
    custom = [("accession", s["accession"]), ("score", score), *_described(s)]
    return F.array(_row("protein_match", last["_start"], last["_end"], score, _attributes_of(s, custom)))


def _rpsblast(m: Column, s: Column, locs: Column) -> Column:
    last = F.element_at(locs, -1)
    custom = [("accession", s["accession"]), ("name", F.coalesce(s["name"], F.lit("None"))),
              ("score", last["_score"]), ("evalue", last["_evalue"]), *_described(s)]
    main = F.array(_row(
        "protein_match", last["_start"], last["_end"], last["_evalue"], _attributes_of(s, custom)))
    sites = F.flatten(F.transform(locs, lambda x: F.coalesce(
        x["sites"]["rpsblast-site"], F.expr(f"cast(array() as {_PLAIN_SITES})"))))
    places = F.flatten(F.transform(sites, lambda x: F.transform(
        x["site-locations"]["site-location"],
        lambda y: F.struct(y.alias("at"), x["_description"].alias("text")))))
    return F.concat(main, _sites(
        s, places, lambda x: x["at"],
        lambda x: [("description", unescape(x["text"])), ("residue", x["at"]["_residue"])]))


def _superfamily(m: Column, s: Column, locs: Column) -> Column:
    last = F.element_at(locs, -1)
    custom = [("evalue", m["_evalue"]), ("accession", s["accession"]), *_described(s)]
    return F.array(_row("protein_hmm_match", last["_start"], last["_end"], m["_evalue"],
                        _attributes_of(s, custom)))


def _each_location(extra: tuple[str, ...], score: str | None):
    """Kinds with one feature per location."""
    def rule(m: Column, s: Column, locs: Column) -> Column:
        return F.transform(locs, lambda x: _row(
            "protein_match", x["_start"], x["_end"], x[f"_{score}"] if score else None,
            _attributes_of(s, [("accession", s["accession"]), *_described(s),
                               *[(n, x[f"_{n}"]) for n in extra]])))
    return rule


RULES = {
    "coils": _region("coils"), "tmhmm": _region("tmhmm"), "mobidblite": _region("mobidblite"),
    "signalp": _signalp,
    "hmmer3": _model_match("hmmer3"), "panther": _model_match("panther"),
    "hmmer2": _model_match("hmmer2"), "hmmer3-with-sites": _model_match("hmmer3-with-sites"),
    "profilescan": _profile_scan, "rpsblast": _rpsblast, "superfamilyhmmer3": _superfamily,
    "fingerprints": _each_location(("pvalue", "score"), "pvalue"),
    "patternscan": _each_location(("level",), None),
}


def _of_kind(matches: Column, kind: str) -> Column:
    """``array<struct<library, library_version, found>>`` of all matches of a kind."""
    def one(m: Column) -> Column:
        signature = F.struct(*[c.alias(n) for n, c in _signature(m["signature"]).items()])
        locs = m["locations"][_location_name(kind)]
        return bound(signature, lambda s: F.struct(
            s["library"].alias("library"), s["library_version"].alias("library_version"),
            RULES[kind](m, s, locs).cast(f"array<{PIECE}>").alias("found")))
    rows = F.transform(matches[_match_name(kind)], one)
    return F.coalesce(rows, F.expr(
        f"cast(array() as array<struct<library: string, library_version: string, found: array<{PIECE}>>>)"))


def _all_features(proteins: DataFrame) -> DataFrame:
    every = F.concat(*[_of_kind(F.col("matches"), kind) for kind in RULES])
    rows = proteins.filter("problem IS NULL").select(
        F.element_at("xref", -1)["_id"].alias("seqid"), "ips_version", F.inline(every))
    tag = source_tag(F.lit("InterProScan"), F.col("ips_version"), F.col("library"), F.col("library_version"))
    return rows.select("seqid", tag.alias("source"), F.inline("found"))


def features(proteins: DataFrame) -> DataFrame:
    """All features of all match kinds, in one pass over the proteins.

    One kind of match is skipped by design (phobius).  The last cross reference
    names the protein.  Broken proteins and features without usable numbers are left out: :func:`bad_proteins`
    and :func:`bad_features` have them.
    """
    return _all_features(proteins).filter("problem IS NULL").drop("problem")


def bad_features(proteins: DataFrame) -> DataFrame:
    """Features whose start, end or score is not a number, with the ``problem``."""
    return _all_features(proteins).filter("problem IS NOT NULL")
