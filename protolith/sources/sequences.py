"""FASTA files, ORF headers, id maps, targets and other small tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import before_last, strip

# --- fixed values: built-in id lists and header layouts ---------------------------
LATEST = {"dbCAN": "8"}
ID_LISTS = {("dbCAN", "8"): ("CBM50", "AA9", "GH10", "GH11")}
ORF_HEADER = r"^\s*(\S+)\s+\[\s*(\d*)\s*-\s*(\d*)\s*\]\s*(\(REVERSE SENSE\))?"
IDMAP = ("encoded", "filename", "id", "checksum", "md5sum")
TARGETS = ("analysis", "software_version", "database_version")
# --- end of fixed values ------------------------------------------------------


def parse_fasta(records: DataFrame, column: str = "value") -> DataFrame:
    """One record per row (``>`` optional) to ``id, description, seq``; other columns stay."""
    body = F.regexp_replace(F.col(column), r"^\s*>?", "")
    header = F.regexp_replace(F.substring_index(body, "\n", 1), r"\r$", "")
    tail = F.when(F.instr(body, "\n") > 0, body.substr(F.instr(body, "\n") + 1, F.length(body)))
    return (
        records.filter(F.trim(F.col(column)) != "")
        .withColumn("id", F.regexp_extract(header, r"^(\S+)", 1))
        .withColumn("description", header)
        .withColumn("seq", F.regexp_replace(F.coalesce(tail, F.lit("")), r"\s+", ""))
        .drop(column)
    )


def read_fasta(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``id, description, seq, filename, block_start, ordinal``.

    ``(filename, block_start, ordinal)`` is file order, and ``(filename, block_start)`` a
    coarsening of it, which is what the numbering operators ask for.
    """
    raw = spark.read.option("lineSep", "\n>").text(paths).select(
        "value", F.col("_metadata.file_name").alias("filename"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("ordinal"))
    return parse_fasta(raw)


def file_order() -> list[str]:
    return ["filename", "block_start", "ordinal"]


def file_bin() -> Column:
    return F.struct("filename", "block_start")


def orf_features(fasta: DataFrame) -> DataFrame:
    """ORF headers ``id [start - end] (REVERSE SENSE)`` to CDS features, 0-based."""
    d = F.col("description")
    a = F.regexp_extract(d, ORF_HEADER, 2).try_cast("int")
    b = F.regexp_extract(d, ORF_HEADER, 3).try_cast("int")
    reverse = F.regexp_extract(d, ORF_HEADER, 4) != ""
    id_ = F.regexp_extract(d, ORF_HEADER, 1)
    return fasta.select(
        before_last(id_, "_").alias("seqid"), F.lit("getorf").alias("source"),
        F.lit("CDS").alias("type"), (F.least(a, b) - 1).alias("start"),
        F.greatest(a, b).alias("end"), F.lit(None).cast("double").alias("score"),
        F.when(reverse, "-").otherwise("+").alias("strand"), F.lit("0").alias("phase"),
        id_.alias("id"))


def orf_order(features: DataFrame) -> DataFrame:
    return features.orderBy("seqid", "start")


def _table_lines(spark: SparkSession, paths, header: str) -> DataFrame:
    lines = spark.read.text(paths).select(strip(F.col("value")).alias("value"))
    return lines.filter((F.col("value") != "") & ~F.col("value").isin(*header.split("|")))


def read_idmap(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Encoded id, file, original id and checksums; file ``.`` or empty is NULL."""
    parts = F.split("value", "\t")
    fields = [F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(IDMAP)]
    rows = _table_lines(spark, paths, "\t".join(IDMAP)).select(*fields)
    return rows.withColumn("filename", F.when(~F.col("filename").isin(".", ""), F.col("filename")))


def read_targets(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Two or three columns, with or without a header; an empty version is NULL."""
    header = "\t".join(TARGETS) + "|" + "\t".join(TARGETS[:2])
    parts = F.split("value", "\t")
    fields = [F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(TARGETS)]
    rows = _table_lines(spark, paths, header).select(*fields)
    return rows.withColumn("database_version", F.nullif("database_version", F.lit("")))


def read_id_list(spark: SparkSession, path: str | None = None, database: str = "dbCAN",
                 version: str = "latest") -> DataFrame:
    """One id per line, or a built-in list by database and version."""
    if path is not None:
        return spark.read.text(path).select(F.trim("value").alias("id")).filter("id <> ''").distinct()
    wanted = LATEST[database] if version == "latest" else version
    if (database, wanted) not in ID_LISTS:
        raise ValueError(f"no id list for {database} {wanted}")
    return spark.createDataFrame([(i,) for i in ID_LISTS[(database, wanted)]], "id string")


def read_ranked(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """A ranked table written by this package or by hand; ``.`` is NULL."""
    return spark.read.schema(schema).csv(paths, sep="\t", header=True, nullValue=".")
