"""Result envelopes: one JSON object per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..analyses import ANALYSES, ENVELOPE
from ..operators.store import prepare

REQUIRED = ("analysis", "software", "software_version", "checksum", "md5sum")


def parse_results(lines: DataFrame, column: str = "value") -> DataFrame:
    """Envelope columns plus ``problem``; payloads stay JSON text.  Blank lines are skipped."""
    fields = [f.strip().split(" ")[0] for f in ENVELOPE.split(",")]

    def check(e: Column) -> Column:
        problem = F.when(e.isNull(), "json")
        for name in REQUIRED:
            problem = problem.when(e[name].isNull(), name)
        problem = problem.when(~e["analysis"].isin(*ANALYSES), "analysis").when(e["data"].isNull(), "data")
        filename = F.get_json_object(e["data"], "$.filename")
        return F.struct(*[e[f].alias(f) for f in fields], filename.alias("filename"), problem.alias("problem"))

    # a generator keeps later filters from repeating the parse
    checked = F.inline(F.transform(F.array(F.from_json(column, ENVELOPE)), check))
    return lines.filter(F.trim(F.col(column)) != "").select(
        *[c for c in lines.columns if c != column], checked)


def read_results(spark: SparkSession, paths: str | list[str], include: list[str] | None = None,
                 exclude: list[str] | None = None, drop_name: bool = False,
                 drop_null_dbversion: bool = False) -> DataFrame:
    """Good result rows, typed and filtered, in a known arrival order.

    :func:`bad_results` has the other lines.
    """
    ok = parse_results(_arriving(spark, paths)).filter("problem IS NULL").drop("problem")
    return prepare(ok, include, exclude, drop_name, drop_null_dbversion)


def bad_results(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The lines that :func:`read_results` cannot use: ``line, problem`` and their arrival."""
    return bad_lines(_arriving(spark, paths)).select("line", "problem", *ARRIVAL)


def bad_lines(lines: DataFrame) -> DataFrame:
    """Malformed envelopes as they came (``line``), with the ``problem`` found."""
    kept = lines.withColumn("line", F.col("value"))
    others = [c for c in lines.columns if c != "value"]
    return parse_results(kept).filter("problem IS NOT NULL").select("line", "problem", *others)


def _arriving(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.text(paths).select(
        "value", F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("ordinal"))


ARRIVAL = ["file_name", "block_start", "ordinal"]
