"""Text lines for each output format, and the writers around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.attributes import attributes_text
from ..functions.text import number_text
from ..operators.graph import tree_order
from ..operators.projection import SIGNAL_PARTS
from ..operators.store import name_column
from ..session import stored

ENVELOPE_ORDER = (
    "analysis", "software", "software_version", "checksum", "md5sum", "data", "database",
    "filename", "database_version", "pipeline_version",
)


# values that start with the comment sign would be quoted
NO_COMMENT = "\u0001"


def _write_lines(df: DataFrame, line: Column, path: str, partition: list[str] | None = None) -> None:
    out = df.select(line.alias("value"), *(partition or []))
    writer = out.write.mode("overwrite")
    (writer.partitionBy(*partition) if partition else writer).text(path)


def ldjson_line(columns: list[str]) -> Column:
    """Compact envelope: NULL fields left out, payload NULLs kept, the name put back."""
    body = F.regexp_replace(F.col("data"), r"\}\s*$", "")
    key = name_column(F.col("analysis"))
    name = F.coalesce(F.col("name"), F.lit(".")) if "name" in columns else F.lit(".")
    quoted = F.regexp_extract(F.to_json(F.struct(name.alias("n"))), r'^\{"n":(.*)\}$', 1)
    field = F.concat(F.lit('"'), key, F.lit('":'), quoted)
    without = F.get_json_object(F.col("data"), "$.name").isNull() & F.get_json_object(
        F.col("data"), "$.query").isNull()
    data = F.when(without, F.concat(
        body, F.when(F.trim(body) == "{", F.lit("")).otherwise(F.lit(",")), field, F.lit("}"))
    ).otherwise(F.col("data"))
    # the payload is JSON already, so it is spliced in after the other fields
    others = F.to_json(F.struct(*[F.col(c) for c in ENVELOPE_ORDER if c != "data" and c in columns]))
    return F.concat(F.regexp_replace(others, r"\}$", ""), F.lit(',"data":'), data, F.lit("}"))


def write_ldjson(df: DataFrame, path: str, partition: list[str] | None = None) -> None:
    _write_lines(df, ldjson_line(df.columns), path, partition)


def fasta_line(id_: str, seq: str, width: int = 60) -> Column:
    """Header and sequence, wrapped."""
    wrapped = F.rtrim(F.regexp_replace(F.col(seq), f"(.{{{width}}})", "$1\n"), F.lit("\n"))
    return F.concat(F.lit(">"), F.col(id_), F.lit("\n"), wrapped)


def write_fasta(df: DataFrame, path: str, id_: str = "encoded", seq: str = "seq",
                partition: list[str] | None = None) -> None:
    _write_lines(df, fasta_line(id_, seq), path, partition)


def write_tsv(df: DataFrame, path: str, digits: int | None = None, na: str = ".",
              partition: list[str] | None = None) -> None:
    """Tab-separated with header; doubles optionally rounded, lists joined by commas."""
    def shown(c: str, t: str) -> Column:
        if t.startswith("array<"):
            return F.array_join(F.col(c).cast("array<string>"), ",", na).alias(c)
        return F.round(c, digits).alias(c) if t == "double" and digits is not None else F.col(c)

    out = df.select(*[shown(c, t) for c, t in df.dtypes])
    writer = out.write.mode("overwrite").option("comment", NO_COMMENT)
    (writer.partitionBy(*partition) if partition else writer).csv(
        path, sep="\t", header=True, nullValue=na, emptyValue="")


def gff_line() -> Column:
    score = F.coalesce(number_text(F.col("score")), F.lit("."))
    return F.concat_ws(
        "\t", "seqid", "source", "type", (F.col("start") + 1).cast("string"),
        F.col("end").cast("string"), score, "strand", "phase", attributes_text(F.col("attributes")))


def write_gff3(df: DataFrame, path: str, partition: list[str] | None = None) -> None:
    _write_lines(df, gff_line(), path, partition)


def gff_tree_lines(df: DataFrame, sort: tuple[str, ...] = ("seqid", "start", "end", "type"), skip: tuple[str, ...] = SIGNAL_PARTS,
                   within: list[str] | None = None) -> DataFrame:
    """Lines in depth-first order, each family closed by ``###``: ``*within, family, position, value``.

    Children follow their parent; a feature below several parents stands where a walk first comes to it.  ``family``
    is the position of the root.  Types in ``skip`` are left out, their children are not.  ``within``
    names columns that split the features into files of their own.
    """
    within = within or []
    rows = stored(df.withColumn("__n", F.monotonically_increasing_id()), "features")
    a = F.col("attributes")
    owners = rows.filter(a["id"].isNotNull()).groupBy(*within, a["id"].alias("__owner")).agg(F.min("__n").alias("parent_id"))
    edges = rows.select(*within, F.col("__n").alias("child_id"), F.explode(a["parent"]).alias("__owner")).join(
        owners, [*within, "__owner"]).select("child_id", "parent_id")
    placed = tree_order(rows.select("__n", *sort), edges, list(sort), id_="__n").select("__n", "root_id", "position")
    placed = stored(placed, "placed")
    roots = placed.filter("__n = root_id").select("root_id", F.col("position").alias("family"))
    lines = rows.join(placed, "__n").join(roots, "root_id")
    ends = lines.groupBy(*within, "family").agg(F.max("position").alias("position")).select(
        *within, "family", "position", F.lit(1).alias("__kind"), F.lit("###").alias("value"))
    kept = lines.filter(~F.coalesce(F.col("type").isin(*skip), F.lit(False)))
    return kept.select(*within, "family", "position", F.lit(0).alias("__kind"), gff_line().alias("value")).unionByName(ends)


def write_gff3_tree(df: DataFrame, path: str, partition: list[str] | None = None, files: int | None = None, **how) -> None:
    """Feature files in tree order: families are dealt into ranges by their root, so each is whole in one file
    and the files follow each other in the order of their names."""
    lines = gff_tree_lines(df, within=partition, **how)
    files = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*(partition or []), "family", "position", "__kind"]
    dealt = lines.repartitionByRange(files, *(partition or []), "family").sortWithinPartitions(*order).select("value", *(partition or []))
    (dealt.write.mode("overwrite").partitionBy(*partition) if partition else dealt.write.mode("overwrite")).text(path)


def write_bedgraph(df: DataFrame, path: str) -> None:
    """Sorted by sequence and start, missing values as NA."""
    ordered = df.withColumnRenamed("seqid", "#seqid").orderBy("#seqid", "start")
    ordered.write.mode("overwrite").option("comment", NO_COMMENT).csv(
        path, sep="\t", header=True, nullValue="NA")


def write_matches(hits: DataFrame, path: str, ldjson: bool = False) -> None:
    if ldjson:
        _write_lines(hits, F.to_json(F.struct(*hits.columns)), path)
    else:
        write_tsv(hits, path)
