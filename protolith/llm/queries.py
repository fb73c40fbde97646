"""The numbered queries over the whole given tables, each a thin projection of its operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, contamination, language, lattice, neardup, phrases, quality, repeats, rules, sharding, toxicity, trie, urls
from .textkit import held_out, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def vocabulary() -> str:
    """The public vocabulary; the file is installed on every machine, never shipped."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces_file() -> str:
    """The public subword vocabulary with scores."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op1_language")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.learn(language.training_rows(docs)))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


@query("op2_quality_discriminant")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


@query("op3_quality_rules")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"))


@query("op4_near_duplicates")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80).drop("text_key", "group")


URL_SQL = """
WITH cut AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut),
ruled AS (
    SELECT *, CASE
        WHEN '.' || host LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN '.' || host LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN '.' || host LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN '.' || host LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule,
      CASE
        WHEN regexp_matches(host, '(^|[.-])adult[.-]') THEN 'adult'
        WHEN regexp_matches(host, '(^|[.-])casino[.-]') THEN 'casino'
        WHEN regexp_matches(host, '(^|[.-])poker[.-]') THEN 'poker'
        WHEN regexp_matches(host, '(^|[.-])spam[.-]') THEN 'spam'
        WHEN regexp_matches(path, '^/([^ ]*/)?wp-login([.]php)?(/|$)') THEN 'wp_login'
        WHEN regexp_matches(path, '^/([^ ]*/)?cart/') THEN 'cart' END AS pattern
    FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict, pattern
FROM ruled
"""


@query("op5_url_filters", URL_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


@query("op6_sharding")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


@query("op7_repeated_passages")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), length=100)


@query("op8_decontamination")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


@query("op9_byte_pairs")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), vocabulary())


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


@query("op11_phrases")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query("op12_text_probability")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score_texts(table(spark, sf_dir, "documents"), pieces_file())


@query("op13_prefix_trie")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))
