"""Predictor outputs whose records span several lines.

The record separator is the text source's line separator, so a file still splits
over tasks and one row is one record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..analyses import PROFILE_ALIGNMENT, RESIDUE_PROPERTIES, RESIDUES, analysis, flat_schema
from ..functions.topology import membrane_flag, signal_flag

# --- fixed values: record separators and labels of block formats ----------------
SEPARATORS = {
    "pepstats": "\nPEPSTATS ", "deeptmhmm": "\n>", "tmbed": "\n>", "hhr": "\nQuery ",
}
COMPOSITION_LABELS = {
    "molecular_weight": "Molecular weight",
    "residues": "Residues",
    "average_residue_weight": "Average Residue Weight",
    "charge": "Charge",
    "isoelectric_point": "Isoelectric Point",
    "a280_molar_extinction_coefficients": "A280 Molar Extinction Coefficients",
    "a280_1mgml_extinction_coefficients": "A280 Extinction Coefficients 1mg/ml",
    "improbability_expression_inclusion_bodies": "Improbability of expression in inclusion bodies",
}
OTHER_LABELS = {"Probability of expression in inclusion bodies": "improbability_expression_inclusion_bodies"}
MEMBRANE_CLASSES = ("SP+TM", "TM+SP", "GLOB", "SP", "TM", "BETA")
PROFILE_SUMMARY = {
    "probability": "Probab", "evalue": "E-value", "score": "Score", "aligned_cols": "Aligned_cols",
    "identity": "Identities", "similarity": "Similarity", "sum_probs": "Sum_probs",
    "template_neff": "Template_Neff",
}
SKIPPED_ROWS = ("ss_dssp", "ss_pred", "Consensus")
# --- end of fixed values ------------------------------------------------------


def _bound(df: DataFrame, **values: Column) -> DataFrame:
    """Add columns that are worked out once: a generator keeps Spark from copying them into each use."""
    return df.select("*", F.inline(F.array(F.struct(*[v.alias(n) for n, v in values.items()]))))


def _with_data(blocks: DataFrame, ddl_types: dict, values: dict[str, Column], required: list[str]) -> DataFrame:
    """Typed ``data``, or the first field without a usable value as ``problem``."""
    typed = F.struct(*[values[n].try_cast(t).alias(n) for n, t in ddl_types.items()])
    rows = _bound(blocks, __data=typed)
    lacking = [F.when(F.col("__data")[n].isNull(), F.lit(n)) for n in required]
    rows = rows.withColumn("problem", F.coalesce(*lacking))
    return rows.withColumn("data", F.when(F.col("problem").isNull(), F.col("__data"))).drop("__data")


def parse_pepstats(blocks: DataFrame, column: str = "value") -> DataFrame:
    """Composition blocks as tokens: scalars are ``label = value``, table rows start with their label.

    A block becomes one list of labels and one of values; of a repeated label the first counts.
    """
    types = {f.name: f.dataType for f in analysis("pepstats").schema.fields}
    # one blank between words, and one label to a line
    plain = F.regexp_replace(F.regexp_replace(F.col(column), "[ \t\r]+", " "), " (?=(Residues|Charge) = )", "\n")
    lines = F.filter(F.split(plain, "\n"), lambda x: F.trim(x) != "")
    rows = _bound(blocks.filter(F.trim(column) != ""), __lines=lines)
    is_scalar = lambda x: F.contains(x, F.lit(" = ")) & (F.instr(x, " = ") > 2)  # noqa: E731  a residue has one letter

    def label(x: Column) -> Column:
        table = F.replace(F.lower(F.substring_index(x, " ", 1)), F.lit("-"))
        return F.when(is_scalar(x), F.trim(F.substring_index(x, " = ", 1))).otherwise(table)

    def value(x: Column) -> Column:
        return F.when(is_scalar(x), F.substring(x, F.instr(x, " = ") + 3, 1 << 30)).otherwise(x)

    text = F.transform(F.col("__lines"), lambda x: F.trim(F.regexp_replace(x, "^PEPSTATS (?=of )", "")))
    rows = _bound(rows, __lines2=text).drop("__lines")
    rows = _bound(rows, __labels=F.transform("__lines2", label), __values=F.transform("__lines2", value)).drop("__lines2")

    def at(name: str) -> Column:
        return F.get("__values", (F.array_position("__labels", name) - 1).cast("int"))

    def words(name: str) -> Column:
        return F.split(at(name), " ")

    found = {n: words(x) for n, x in COMPOSITION_LABELS.items()}
    for other, n in OTHER_LABELS.items():
        found[n] = F.coalesce(found[n], words(other))
    tables = [(f"residue_{aa}", words(aa)) for aa in RESIDUES] + [(f"property_{p}", words(p)) for p in RESIDUE_PROPERTIES]
    rows = _bound(rows, __name=F.get(words("of"), F.lit(1)), **{f"__{n}": v for n, v in [*found.items(), *tables]}).drop("__labels", "__values")
    word = lambda name, i: F.get(f"__{name}", F.lit(i))
    values = {"name": F.col("__name"), **{n: word(n, 0) for n in COMPOSITION_LABELS if not n.startswith("a280")}}
    for n in (n for n in COMPOSITION_LABELS if n.startswith("a280")):
        # a number and what it holds for, twice
        values[f"{n}_reduced"] = F.when(word(n, 1) == "(reduced)", word(n, 0))
        values[f"{n}_cysteine_bridges"] = F.when(word(n, 3) == "(cystine", word(n, 2))
    values["isoelectric_point"] = F.nullif(values["isoelectric_point"], F.lit("None"))
    for aa in RESIDUES:
        # A = Ala 10 1.5 0.25
        for i, measure in enumerate(("number", "mole", "dayhoff")):
            values[f"residue_{aa}_{measure}"] = F.when(word(f"residue_{aa}", 1) == "=", word(f"residue_{aa}", 3 + i))
    for p in RESIDUE_PROPERTIES:
        # Tiny (A+C+G+S+T) 12 30.0
        for i, measure in enumerate(("number", "mole")):
            values[f"property_{p}_{measure}"] = F.when(F.startswith(word(f"property_{p}", 1), F.lit("(")), word(f"property_{p}", 2 + i))
    out = _with_data(rows, types, values, [n for n in types if n != "isoelectric_point"])
    return out.drop("__name", *(f"__{n}" for n in COMPOSITION_LABELS), *(f"__{n}" for n, _ in tables))


def _kept_lines(block: Column) -> Column:
    lines = F.transform(F.split(block, "\n"), lambda x: F.trim(F.regexp_replace(x, r"[\r\t]+$", "")))
    return F.filter(lines, lambda x: (x != "") & ~x.startswith("#"))


def _label_block(blocks: DataFrame, column: str) -> DataFrame:
    """Blocks of a header, a sequence and a label line, as ``__head`` and ``__labels``."""
    rows = _bound(blocks, __l=_kept_lines(F.col(column))).filter(F.size("__l") > 0)
    return rows.withColumns({"__head": F.regexp_replace(F.get("__l", F.lit(0)), "^>+", ""), "__labels": F.get("__l", F.lit(2))}).drop("__l")


def parse_deeptmhmm(blocks: DataFrame, column: str = "value") -> DataFrame:
    """Header (``name | class``), sequence, labels."""
    types = {f.name: f.dataType for f in analysis("deeptmhmm").schema.fields}
    rows = _label_block(blocks, column)
    name = F.trim(F.substring_index("__head", "|", 1))
    kind = F.when(F.contains("__head", F.lit("|")), F.substring_index(F.trim(F.get(F.split("__head", "[|]"), F.lit(1))), " ", 1))
    # a header without a known class names nothing
    known = kind.isin(*MEMBRANE_CLASSES) & ~name.rlike(r"\s")
    values = {"name": F.when(known, F.nullif(name, F.lit(""))), "prediction": F.when(known, kind), "topology": F.col("__labels")}
    return _with_data(rows, types, values, list(types)).drop("__head", "__labels")


def parse_tmbed(blocks: DataFrame, column: str = "value") -> DataFrame:
    """Header, sequence, labels; the flags are derived from the labels."""
    types = {f.name: f.dataType for f in analysis("tmbed").schema.fields}
    rows = _label_block(blocks, column)
    valid = F.when(F.col("__labels").rlike(r"^[SBbHh.]*$"), F.col("__labels"))
    values = {
        "name": F.nullif(F.substring_index("__head", " ", 1), F.lit("")), "topology": valid,
        "has_sp": signal_flag(valid), "has_tm": membrane_flag(valid),
    }
    return _with_data(rows, types, values, ["name", "topology"]).drop("__head", "__labels")


def parse_hhr(blocks: DataFrame, column: str = "value") -> DataFrame:
    """Profile alignments: a query block holds one row per template.

    The lines of a template are cut once; alignment rows become structs of their columns, and everything
    else follows from those.
    """
    types = {f.name: f.dataType for f in flat_schema(PROFILE_ALIGNMENT).fields}
    block = F.concat(F.lit("Query "), F.regexp_replace(F.col(column), r"^Query\s+", ""))
    rows = _bound(blocks.filter(F.trim(F.col(column)) != ""), __p=F.split(block, r"\n(?=>)"))
    head = F.split(F.get("__p", F.lit(0)), "\n")

    def headed(label: str) -> Column:
        """The words behind a label at the start of a line of the query's head."""
        mine = F.get(F.filter(head, lambda x: F.startswith(x, F.lit(label + " "))), F.lit(0))
        return F.ltrim(F.substring(mine, len(label) + 1, 1 << 30))

    rows = _bound(rows, __query=F.nullif(headed("Query"), F.lit("")), __length=F.substring_index(headed("Match_columns"), " ", 1),
                  __neff=F.substring_index(headed("Neff"), " ", 1),
                  __templates=F.slice("__p", F.lit(2), F.greatest(F.size("__p") - 1, F.lit(0)))).drop("__p")
    rows = rows.withColumn("__a", F.explode("__templates")).drop("__templates")
    rows = _bound(rows, __lines=F.split("__a", "\n")).drop("__a")

    def aligned(tag: str) -> Column:
        """Rows ``T name start letters end (length)`` as structs, without the derived tracks."""
        cells = F.transform(F.filter("__lines", lambda x: F.startswith(x, F.lit(tag + " "))), lambda x: F.struct(
            x.alias("line"), F.split(F.trim(x), r"\s+").alias("w")))
        fits = F.filter(cells, lambda c: (F.size(c["w"]) == 6) & ~F.get(c["w"], F.lit(1)).isin(*SKIPPED_ROWS)
                        & F.get(c["w"], F.lit(2)).rlike(r"^\d+$") & F.get(c["w"], F.lit(4)).rlike(r"^\d+$"))
        return F.transform(fits, lambda c: F.struct(
            F.get(c["w"], F.lit(2)).try_cast("int").alias("start"), F.get(c["w"], F.lit(3)).alias("letters"),
            F.get(c["w"], F.lit(4)).try_cast("int").alias("end"),
            F.get(c["w"], F.lit(5)).substr(F.lit(2), F.length(F.get(c["w"], F.lit(5))) - 2).alias("length"),
            # the alignment begins behind the start's column
            F.length(F.regexp_extract(c["line"], rf"^{tag}\s+\S+\s+\d+\s+", 0)).alias("column")))

    rows = _bound(rows, __q=aligned("Q"), __t=aligned("T"), __title=F.get("__lines", F.lit(0)),
                  __summary=F.split(F.get(F.filter("__lines", lambda x: F.startswith(x, F.lit("Probab"))), F.lit(0)), r"\s+"),
                  __conf=F.filter("__lines", lambda x: F.startswith(x, F.lit("Confidence")))).drop("__lines")
    q, t = F.col("__q"), F.col("__t")
    begin = F.get(t, F.lit(0))["column"]
    padded = F.zip_with("__conf", t, lambda c, x: F.rpad(c.substr(begin + 1, F.length(x["letters"])), F.length(x["letters"]), " "))

    def of_summary(name: str) -> Column:
        mine = F.get(F.filter("__summary", lambda x: F.startswith(x, F.lit(name + "="))), F.lit(0))
        return F.nullif(F.substring(mine, len(name) + 2, 1 << 30), F.lit(""))

    values = {
        "query_id": F.col("__query"), "query_length": F.col("__length"), "query_neff": F.col("__neff"),
        "template_id": F.nullif(F.substring_index(F.regexp_replace("__title", "^>", ""), " ", 1), F.lit("")),
        "template_info": F.col("__title"),
        "template_length": F.element_at(t["length"], -1),
        "query_ali": F.array_join(q["letters"], ""), "template_ali": F.array_join(t["letters"], ""),
        "confidence": F.replace(F.array_join(padded, ""), F.lit(" "), F.lit("-")),
        "query_start": F.array_min(q["start"]), "query_end": F.array_max(q["end"]),
        "template_start": F.array_min(t["start"]), "template_end": F.array_max(t["end"]),
        **{name: of_summary(label) for name, label in PROFILE_SUMMARY.items()},
    }
    values["identity"] = F.replace(values["identity"], F.lit("%")).try_cast("double") / 100
    required = [n for n in types if n != "template_neff"]
    return _with_data(rows, types, values, required).drop(
        "__query", "__length", "__neff", "__q", "__t", "__title", "__summary", "__conf")


PARSERS = {
    "pepstats": parse_pepstats, "deeptmhmm": parse_deeptmhmm, "tmbed": parse_tmbed, "hhr": parse_hhr,
}


def read_blocks(spark: SparkSession, kind: str, paths: str | list[str]) -> DataFrame:
    """Typed ``data`` plus ``problem``, one row per record."""
    raw = spark.read.option("lineSep", SEPARATORS[kind]).text(paths).withColumn(
        "file_name", F.col("_metadata.file_name"))
    return PARSERS[kind](raw)
