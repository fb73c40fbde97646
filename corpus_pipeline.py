"""The training-data pipeline: quality rules, near-duplicates, repeated passages, decontamination, encoding.

Every stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written as Parquet and
read again as the next stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from protolith.llm import bpe, contamination, neardup, repeats, rules
from protolith.llm.queries import vocabulary
from protolith.llm.textkit import LAST_ID, table
from protolith.session import configure, scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base counts or the compression bands reject go."""
    packed = docs.select("doc_id", "text", *(F.col(c).alias(f"given_{c}") for c in COLUMNS))
    judged = rules.judge(packed, extra=[f"given_{c}" for c in COLUMNS]).filter("kept")
    return judged.select(*(F.col(f"given_{c}").alias(c) for c in COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at a similarity of 0.8 over five-word shingles stays.

    It is the one with the smallest id, and of several texts under that id the one with the smallest
    hash; a group without any id keeps one text as well.  Rows of one id and one text are one document.
    Texts without words are in no group and stay.
    """
    found = neardup.near_duplicates(docs.select("doc_id", "text"), words=5, percent=80)
    found = found.select(_id().alias("id"), "text_key", "group", "kept")
    firsts = found.filter(F.col("kept") & F.col("group").isNotNull()).groupBy("group").agg(
        F.min("id").alias("id"), F.min("text_key").alias("text_key"))
    empty = found.filter(F.col("group").isNull())
    keys = firsts.select("id", "text_key").union(empty.select("id", "text_key")).distinct()
    rows = docs.select(*COLUMNS, _id().alias("id"), F.xxhash64("text").alias("text_key")).join(keys, ["id", "text_key"], "left_semi")
    return rows.dropDuplicates(["id", "text_key"]).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every passage of 100 bytes that also starts earlier is cut out; texts of which nothing is left go."""
    packed = docs.select("doc_id", "text", *(F.col(c).alias(f"given_{c}") for c in COLUMNS if c not in ("doc_id", "text", "n_chars")))
    cut = repeats.remove_repeats(packed, length=100, extra=["given_lang", "given_source"], with_text=True)
    left = cut.filter((F.col("n_removed") == 0) | (F.trim("text") != ""))
    return left.select("doc_id", "text", F.col("given_lang").alias("lang"), F.col("given_source").alias("source"),
                       F.length("text").cast("long").alias("n_chars"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold at least half of the words of a benchmark item go."""
    pairs = contamination.contaminated(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    bad = pairs.select(_id().alias("id"), "text_key").distinct()
    rows = docs.select(*COLUMNS, _id().alias("id"), F.xxhash64("text").alias("text_key"))
    return rows.join(bad, ["id", "text_key"], "left_anti").select(*COLUMNS)


def byte_pairs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text that is left, with the digests of ids and decoded text."""
    return bpe.encode(docs, vocabulary(), with_ids=True)


def _id():
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("byte_pairs", byte_pairs),
]

#: Hash joins over shingles, passages and tiles have no sound SQL form; the stages are tested as a chain against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
