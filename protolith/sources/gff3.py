"""Feature tables (GFF3): 1-based inclusive on disk, 0-based half-open in memory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.attributes import attribute_pairs, attributes_from
from ..functions.text import trimmed

COLUMNS = ("seqid", "source", "type", "start", "end", "score", "strand", "phase", "attributes")


def parse_gff3(lines: DataFrame, column: str = "value", strip_quote: bool = False) -> DataFrame:
    """Feature columns plus ``problem``; comments and blank lines are skipped."""
    kept = lines.filter((F.trim(F.col(column)) != "") & ~F.col(column).startswith("#"))
    others = [c for c in lines.columns if c != column]
    # a filter on what is read moves below a selection and would split the line for each use; it stays above an explode
    split = kept.select(*others, F.explode(F.array(F.split(trimmed(F.col(column)), "\t"))).alias("__parts"))
    parts = F.col("__parts")
    f = {name: F.get(parts, F.lit(i)) for i, name in enumerate(COLUMNS)}
    a = f["start"].try_cast("int") - 1
    b = f["end"].try_cast("int")
    score = F.when(f["score"] != ".", f["score"].try_cast("double"))
    checks = (
        ("columns", F.size(parts) >= len(COLUMNS) - 1),
        ("seqid", F.trim(f["seqid"]) != ""), ("source", F.trim(f["source"]) != ""),
        ("type", F.trim(f["type"]) != ""), ("start", a.isNotNull()), ("end", b.isNotNull()),
        ("score", (f["score"] == ".") | score.isNotNull()),
        ("strand", f["strand"].isin("+", "-", ".", "?")),
        ("phase", f["phase"].isin("0", "1", "2", ".")),
        ("length", a != b),
    )
    problem = F.lit(None).cast("string")
    for name, ok in reversed(checks):
        problem = F.when(~F.coalesce(ok, F.lit(False)), name).otherwise(problem)
    rows = split.select(
        *others, f["seqid"].alias("seqid"), f["source"].alias("source"), f["type"].alias("type"),
        F.least(a, b).alias("start"), F.greatest(a, b).alias("end"), score.alias("score"),
        f["strand"].alias("strand"), f["phase"].alias("phase"),
        attribute_pairs(f["attributes"], strip_quote).alias("__pairs"), problem.alias("problem"))
    return rows.withColumn("attributes", attributes_from(F.col("__pairs"))).select(*others, *COLUMNS, "problem")


def read_gff3(spark: SparkSession, paths: str | list[str], strip_quote: bool = False) -> DataFrame:
    raw = spark.read.text(paths).select("value", F.col("_metadata.file_name").alias("file_name"))
    return parse_gff3(raw, strip_quote=strip_quote)


def feature_id(field: str = "Parent") -> Column:
    """The one id that links a feature to its protein; NULL when it is missing.

    More than one distinct value is an error in the data.
    """
    single = {"ID": "id", "Name": "name"}
    listed = {"Parent": "parent", "Derives_from": "derives_from", "Alias": "alias",
              "Dbxref": "dbxref", "Note": "note", "Ontology_term": "ontology_term"}
    a = F.col("attributes")
    if field in single:
        return a[single[field]]
    values = a[listed[field]] if field in listed else F.try_element_at(a["custom"], F.lit(field))
    distinct = F.array_distinct(values)
    return F.when(F.size(distinct) > 1, F.raise_error(F.concat(
        F.lit(f"several {field} values: "), F.array_join(distinct, ","))).cast("string")).otherwise(
        F.get(distinct, F.lit(0)))


def coding_exons(features: DataFrame, field: str = "Parent") -> DataFrame:
    """CDS rows with the protein id they belong to; rows without one are skipped."""
    cds = features.filter(F.col("type") == "CDS").withColumn("id", feature_id(field))
    return cds.filter(F.col("id").isNotNull())
