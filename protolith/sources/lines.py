"""One job for all line-oriented predictor outputs.

A format is data: how a line splits, which lines to skip, and one parser per
payload column.  A parser turns a field into a value column and a validity
column, so a whole file is one projection; rows that fail any check go to the
quarantine side with the name of the first failing column.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..analyses import analysis
from ..functions.text import key_value, matched, strip

Parsed = tuple[Column, Column]
Parser = Callable[[Column], Parsed]


def text(c: Column) -> Parsed:
    return c, F.trim(c) != ""


def integer(c: Column) -> Parsed:
    v = F.trim(c).try_cast("int")
    return v, v.isNotNull()


def number(c: Column) -> Parsed:
    v = F.trim(c).try_cast("double")
    return v, v.isNotNull()


def zero_based(c: Column) -> Parsed:
    v, ok = integer(c)
    return v - 1, ok


def flag(true: str, *false: str) -> Parser:
    return lambda c: (c == true, c.isin(true, *false))


def one_of(*options: str) -> Parser:
    return lambda c: (c, c.isin(*options))


def or_null(parser: Parser, token: str) -> Parser:
    def parse(c: Column) -> Parsed:
        v, ok = parser(c)
        return F.when(c != token, v), (c == token) | ok
    return parse


def optional(parser: Parser) -> Parser:
    """For trailing columns that may be missing altogether."""
    def parse(c: Column) -> Parsed:
        v, ok = parser(c)
        return F.when(c.isNotNull(), v), c.isNull() | ok
    return parse


def keyed(key: str, parser: Parser) -> Parser:
    def parse(c: Column) -> Parsed:
        v, ok = parser(key_value(c, key))
        return v, F.coalesce(ok, F.lit(False))
    return parse


def pattern(regex: str, group: int, parser: Parser, null: str = "-") -> Parser:
    """A regex group of the trimmed field; the null token gives NULL."""
    def parse(c: Column) -> Parsed:
        field = F.trim(c)
        v, ok = parser(matched(field, regex, group))
        return F.when(field != null, v), (field == null) | (field.rlike(regex) & ok)
    return parse


def decided(regex: str, null: str = "-") -> Parser:
    """False for the null token, True for a field that matches."""
    def parse(c: Column) -> Parsed:
        field = F.trim(c)
        return field != null, (field == null) | field.rlike(regex)
    return parse


def replaced(parser: Parser, old: str, new: str) -> Parser:
    def parse(c: Column) -> Parsed:
        v, ok = parser(c)
        return F.when(v == old, new).otherwise(v), ok
    return parse


def delimited(separator: str, *options: str) -> Parser:
    def parse(c: Column) -> Parsed:
        parts = F.filter(F.split(c, separator), lambda p: p != "")
        return parts, F.forall(parts, lambda p: p.isin(*options))
    return parse


def shifted(parser: Parser, by: int) -> Parser:
    def parse(c: Column) -> Parsed:
        v, ok = parser(c)
        return v + by, ok
    return parse


def without_suffix(suffix: str) -> Parser:
    def parse(c: Column) -> Parsed:
        v, ok = text(c)
        at = F.length(v) - F.length(F.substring_index(v, suffix, -1)) - len(suffix)
        return F.when(v.contains(suffix), v.substr(F.lit(1), at)).otherwise(v), ok
    return parse


@dataclass(frozen=True)
class LineFormat:
    """How the lines of one result kind look."""

    split: str
    arity: tuple[int, int]
    columns: tuple[tuple[str, int, Parser], ...]
    skip: str | None = None
    banner: str | None = None


# --- fixed values: line layouts per result kind ----------------------------------
# column, position on the line, parser
TAB, SPACE, COMMA = "\t", r"\s+", r"\s*,\s*"
YES_NO = flag("Y", "N")
DASHES = r"^---------"

_SIGNALP3_NN = (
    ("name", 0, text), ("cmax", 1, number), ("cmax_pos", 2, integer), ("cmax_decision", 3, YES_NO),
    ("ymax", 4, number), ("ymax_pos", 5, integer), ("ymax_decision", 6, YES_NO),
    ("smax", 7, number), ("smax_pos", 8, integer), ("smax_decision", 9, YES_NO),
    ("smean", 10, number), ("smean_decision", 11, YES_NO), ("d", 12, number), ("d_decision", 13, YES_NO),
)
_SIGNALP3_HMM = (
    ("name", 0, text), ("is_secreted", 1, flag("S", "Q", "A")), ("cmax", 2, number),
    ("cmax_pos", 3, integer), ("cmax_decision", 4, YES_NO), ("sprob", 5, number),
    ("sprob_decision", 6, YES_NO),
)
_SIGNALP4 = (
    ("name", 0, text), ("cmax", 1, number), ("cmax_pos", 2, integer), ("ymax", 3, number),
    ("ymax_pos", 4, integer), ("smax", 5, number), ("smax_pos", 6, integer), ("smean", 7, number),
    ("d", 8, number), ("decision", 9, YES_NO), ("dmax_cut", 10, number), ("networks_used", 11, text),
)
_SIGNALP5_KINDS = one_of("SP(Sec/SPI)", "LIPO(Sec/SPII)", "TAT(Tat/SPI)", "OTHER")
_SIGNALP6_KINDS = one_of("OTHER", "SP", "LIPO", "TAT", "TATLIPO", "PILIN", "NO_SP")
_SIGNALP5 = (
    ("name", 0, text), ("prediction", 1, _SIGNALP5_KINDS), ("prob_signal", 2, number),
    ("prob_other", 3, number), ("cs_pos", 4, optional(text)),
)
_SIGNALP6 = (
    ("name", 0, text), ("prediction", 1, _SIGNALP6_KINDS), ("prob_signal", 3, number),
    ("prob_other", 2, number), ("cs_pos", 4, optional(text)),
)
_DEEPSIG = (
    ("name", 0, text), ("prediction", 1, one_of("SignalPeptide", "Transmembrane", "Other")),
    ("prob", 2, number), ("cs_pos", 3, or_null(integer, "-")),
)
_PHOBIUS = (("name", 0, text), ("tm", 1, integer), ("sp", 2, flag("Y", "0")), ("topology", 3, text))
_TMHMM = (
    ("name", 0, text), ("length", 1, keyed("len", integer)), ("exp_aa", 2, keyed("ExpAA", number)),
    ("first_60", 3, keyed("First60", number)), ("pred_hel", 4, keyed("PredHel", integer)),
    ("topology", 5, keyed("Topology", text)),
)
_DEEPLOC_KINDS = one_of(
    "Membrane", "Nucleus", "Cytoplasm", "Extracellular", "Mitochondrion", "Cell_membrane",
    "Endoplasmic_reticulum", "Plastid", "Golgi_apparatus", "Lysosome/Vacuole", "Peroxisome")
_DEEPLOC2_KINDS = delimited(
    r"\|", "Cytoplasm", "Nucleus", "Extracellular", "Cell membrane", "Mitochondrion", "Plastid",
    "Endoplasmic reticulum", "Lysosome/Vacuole", "Golgi apparatus", "Peroxisome")
_DEEPLOC2_SIGNALS = delimited(
    r"\|", "Signal peptide", "Transmembrane domain", "Mitochondrial transit peptide",
    "Chloroplast transit peptide", "Thylakoid luminal transit peptide",
    "Nuclear localization signal", "Nuclear export signal", "Peroxisomal targeting signal")
_TARGETP_KINDS = one_of("OTHER", "noTP", "SP", "mTP", "cTP", "luTP")
_TARGETP_PLANT = (
    ("name", 0, text), ("prediction", 1, _TARGETP_KINDS), ("other", 2, number), ("sp", 3, number),
    ("mtp", 4, number), ("ctp", 5, number), ("lutp", 6, number), ("cs_pos", 7, optional(lambda c: (c, F.lit(True)))),
)
_TARGETP_NON_PLANT = (
    ("name", 0, text), ("prediction", 1, replaced(_TARGETP_KINDS, "noTP", "OTHER")),
    ("other", 2, number), ("sp", 3, number), ("mtp", 4, number),
    ("cs_pos", 5, optional(lambda c: (c, F.lit(True)))),
)


def _prediction(*options: str) -> tuple:
    return (("name", 0, text), ("prediction", 1, one_of(*options)), ("prob", 2, number))


_E3 = r"^Y \((\d?\.?\d+)\)$"
_EFFECTORP3 = (
    ("name", 0, text),
    ("prediction", 4, one_of(
        "Cytoplasmic effector", "Apoplastic effector", "Cytoplasmic/apoplastic effector",
        "Apoplastic/cytoplasmic effector", "Non-effector")),
    ("cytoplasmic_prob", 1, pattern(_E3, 1, number)), ("apoplastic_prob", 2, pattern(_E3, 1, number)),
    ("noneffector_prob", 3, pattern(_E3, 1, number)),
)
_DEEPREDEFF = (
    ("name", 0, text), ("s_score", 1, number), ("prediction", 2, one_of("effector", "non-effector")),
)
_TRANSIT = r"^Y \((\d?\.?\d+)\s*\|\s*(\d+)-(\d+)\)$"
_NUCLEUS = r"^Y \((.+)\)$"


def _organ(name: str, at: int) -> tuple:
    # predicted starts count from residue 20
    return (
        (f"{name}_decision", at, decided(_TRANSIT)), (f"{name}_prob", at, pattern(_TRANSIT, 1, number)),
        (f"{name}_start", at, shifted(pattern(_TRANSIT, 2, integer), 19)),
        (f"{name}_end", at, pattern(_TRANSIT, 3, integer)),
    )


_LOCALIZER = (
    ("name", 0, text), *_organ("chloroplast", 1), *_organ("mitochondria", 2),
    ("nucleus_decision", 3, decided(_NUCLEUS)), ("nucleus_signals", 3, pattern(_NUCLEUS, 1, text)),
)


def active_sites(c: Column) -> Parsed:
    """``predicted_active_site[1,2][3]`` to ``1,2;3``."""
    body = F.regexp_replace(F.trim(c), "^predicted_active_site", "")
    parts = F.transform(F.split(body, r"\["), lambda p: F.replace(
        F.regexp_replace(p, r"^[\[\],; ]+|[\[\],; ]+$", ""), F.lit(" "), F.lit("")))
    return F.array_join(F.filter(parts, lambda p: p != ""), ";"), F.trim(c).startswith("predicted_active_site")


_PFAMSCAN = (
    ("name", 0, text), ("ali_start", 1, zero_based), ("ali_end", 2, integer),
    ("env_start", 3, zero_based), ("env_end", 4, integer), ("hmm", 5, text), ("hmm_name", 6, text),
    ("hmm_type", 7, text), ("hmm_start", 8, zero_based), ("hmm_end", 9, integer),
    ("hmm_len", 10, integer), ("bitscore", 11, number), ("evalue", 12, number),
    ("is_significant", 13, flag("1", "0")), ("clan", 14, or_null(text, "No_clan")),
    ("active_sites", 15, optional(active_sites)),
)
_DOMAINS = (
    ("query", 3, text), ("hmm", 0, without_suffix(".hmm")), ("hmm_len", 2, integer),
    ("query_len", 5, integer), ("full_evalue", 6, number), ("full_score", 7, number),
    ("full_bias", 8, number), ("nmatches", 10, integer), ("domain_c_evalue", 11, number),
    ("domain_i_evalue", 12, number), ("domain_score", 13, number), ("domain_bias", 14, number),
    ("hmm_from", 15, zero_based), ("hmm_to", 16, integer), ("query_from", 17, zero_based),
    ("query_to", 18, integer), ("acc", 21, number),
    ("description", 22, optional(lambda c: (F.when(~c.isin("-", ""), c), F.lit(True)))),
)
_ALIGNMENT = (
    ("query", 0, text), ("target", 1, text), ("qstart", 2, zero_based), ("qend", 3, integer),
    ("qlen", 4, integer), ("tstart", 5, zero_based), ("tend", 6, integer), ("tlen", 7, integer),
    ("evalue", 8, number), ("gapopen", 9, integer), ("pident", 10, number), ("alnlen", 11, integer),
    ("raw", 12, number), ("bits", 13, number), ("cigar", 14, text), ("mismatch", 15, integer),
    ("qcov", 16, number), ("tcov", 17, number),
)
_MOTIF_HIT = (
    ("name", 0, text), ("kind", 1, text), ("pattern", 2, text), ("match", 3, text),
    ("start", 4, integer), ("end", 5, integer),
)


# --- fixed values: columns of the two localisation tables -------------------------
_DEEPLOC = (
    ("name", 0, text), ("prediction", 1, _DEEPLOC_KINDS),
    ("membrane", 2, number), ("nucleus", 3, number), ("cytoplasm", 4, number), ("extracellular", 5, number),
    ("mitochondrion", 6, number), ("cell_membrane", 7, number), ("endoplasmic_reticulum", 8, number),
    ("plastid", 9, number), ("golgi_apparatus", 10, number), ("lysosome_vacuole", 11, number),
    ("peroxisome", 12, number),
)
_DEEPLOC2 = (
    ("name", 0, text), ("localisations", 1, _DEEPLOC2_KINDS), ("signals", 2, _DEEPLOC2_SIGNALS),
    ("cytoplasm", 3, number), ("nucleus", 4, number), ("extracellular", 5, number), ("cell_membrane", 6, number),
    ("mitochondrion", 7, number), ("plastid", 8, number), ("endoplasmic_reticulum", 9, number),
    ("lysosome_vacuole", 10, number), ("golgi_apparatus", 11, number), ("peroxisome", 12, number),
)
# --- end of fixed values ------------------------------------------------------
_HITS = LineFormat(TAB, (6, 6), _MOTIF_HIT, skip=r"^name\tkind\tpattern\tmatch\tstart\tend$")
_DOMAIN_LINES = LineFormat(SPACE, (22, 23), _DOMAINS)
_DEEPREDEFF_LINES = LineFormat(TAB, (3, 3), _DEEPREDEFF, skip=r"^name\ts_score\tprediction$")

FORMATS: dict[str, LineFormat] = {
    "signalp3_nn": LineFormat(SPACE, (14, 14), _SIGNALP3_NN, skip="^error running HOW$"),
    "signalp3_hmm": LineFormat(SPACE, (7, 7), _SIGNALP3_HMM),
    "signalp4": LineFormat(SPACE, (12, 12), _SIGNALP4),
    "signalp5": LineFormat(TAB, (4, 5), _SIGNALP5),
    "signalp6": LineFormat(TAB, (4, 5), _SIGNALP6),
    "deepsig": LineFormat(TAB, (4, 4), _DEEPSIG),
    "phobius": LineFormat(SPACE, (4, 4), _PHOBIUS, skip="^SEQENCE"),
    "tmhmm": LineFormat(TAB, (6, 6), _TMHMM, skip="^WARNING"),
    "deeploc": LineFormat(TAB, (13, 13), _DEEPLOC, skip=r"^ID\tLocation\tMembrane"),
    "deeploc2": LineFormat(COMMA, (13, 13), _DEEPLOC2, skip="^Protein_ID,Localizations,Signals"),
    "targetp_plant": LineFormat(TAB, (7, 8), _TARGETP_PLANT),
    "targetp_non_plant": LineFormat(TAB, (5, 6), _TARGETP_NON_PLANT),
    "effectorp1": LineFormat(TAB, (3, 3), _prediction("Effector", "Non-effector"), banner=DASHES),
    "effectorp2": LineFormat(
        TAB, (3, 3), _prediction("Effector", "Unlikely effector", "Non-effector"), banner=DASHES),
    "effectorp3": LineFormat(TAB, (5, 5), _EFFECTORP3, banner=DASHES),
    "effectorp3_fungal": LineFormat(TAB, (5, 5), _EFFECTORP3, banner=DASHES),
    "apoplastp": LineFormat(TAB, (3, 3), _prediction("Apoplastic", "Non-apoplastic"), banner=DASHES),
    "localizer": LineFormat(TAB, (4, 4), _LOCALIZER,
                            skip=r"^Identifier\s+Chloroplast\s+Mitochondria\s+Nucleus$"),
    "pfamscan": LineFormat(SPACE, (15, 16), _PFAMSCAN),
    "dbcan": _DOMAIN_LINES,
    "effectordb": _DOMAIN_LINES,
    "phibase": LineFormat(TAB, (18, 18), _ALIGNMENT),
    "regexanalysis": _HITS,
    "kex2_cutsite": _HITS,
    "rxlr_like_motif": _HITS,
    "deepredeff_fungi": _DEEPREDEFF_LINES,
    "deepredeff_oomycete": _DEEPREDEFF_LINES,
    "deepredeff_bacteria": _DEEPREDEFF_LINES,
}
# --- end of fixed values ------------------------------------------------------


def parse_lines(lines: DataFrame, kind: str, column: str = "value") -> DataFrame:
    """Lines to ``data`` (typed struct) and ``problem`` (NULL when the line is good).

    Comments, blank lines and headers are left out.  Other columns are carried.
    """
    spec = FORMATS[analysis(kind).name]
    line = strip(F.col(column))
    kept = lines.filter((line != "") & ~line.startswith("#"))
    if spec.skip:
        kept = kept.filter(~line.rlike(spec.skip))
    # free text at the end of a line may contain the separator
    limit = spec.arity[1] if spec.split == SPACE and spec.arity[0] != spec.arity[1] else -1
    # a generator keeps later filters from repeating the split
    fields = kept.select("*", F.explode(F.array(F.split(line, spec.split, limit))).alias("__f"))
    f = F.col("__f")
    parsed = {name: parser(F.trim(F.get(f, F.lit(at))) if spec.split != TAB else F.get(f, F.lit(at)))
              for name, at, parser in spec.columns}
    types = {x.name: x.dataType for x in analysis(kind).schema.fields}
    size = F.size(f)
    problem = F.when(~size.between(*spec.arity), F.lit("columns"))
    for name, _, _ in spec.columns:
        problem = problem.when(~F.coalesce(parsed[name][1], F.lit(False)), F.lit(name))
    data = F.struct(*[parsed[n][0].cast(types[n]).alias(n) for n in types])
    return fields.withColumn("problem", problem).withColumn(
        "data", F.when(F.col("problem").isNull(), data)).drop("__f")


def good(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("problem").isNull()).drop("problem")


def quarantine(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("problem").isNotNull()).drop("data")


def read_lines(spark: SparkSession, kind: str, paths: str | list[str]) -> DataFrame:
    """Read one result kind.

    Some tools print a banner between two dashed lines; such files are read whole
    lines as well, and the banner is recognised by not looking like data.
    """
    lines = spark.read.text(paths).withColumn("file_name", F.col("_metadata.file_name"))
    spec = FORMATS[analysis(kind).name]
    if spec.banner:
        # banner lines hold no tab; data lines always do
        lines = lines.filter(F.col("value").contains("\t"))
    return parse_lines(lines, kind)


def envelope(parsed: DataFrame, kind: str, software_version: str, database_version: str | None = None,
             pipeline_version: str | None = None) -> DataFrame:
    """Typed payloads to result rows, ``data`` as compact JSON."""
    a = analysis(kind)
    constants = {
        "analysis": a.name, "software": a.software, "software_version": software_version,
        "database": a.database, "database_version": database_version,
        "pipeline_version": pipeline_version,
    }
    rows = parsed.withColumn("name", F.col(f"data.{a.name_column}"))
    for name, value in constants.items():
        rows = rows.withColumn(name, F.lit(value).cast("string"))
    return rows.withColumn("data", F.to_json("data", {"ignoreNullFields": "false"}))
