"""URL filters: pattern rules indexed by their rarest literal token.

A rule is one regular expression over the host and one over the path, and names the literal tokens that any
URL it fits must hold.  It is filed under the one of them that is rarest in the given URLs.  The
tokens of a URL fetch the rules filed under them, and only those run.

A short rule list travels to the executors as an index.  A list of any length can come as a table: then
tokens are counted, rules filed and candidates fetched by joins.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from protolith.session import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    name: str
    verdict: str            # allow or block
    host: str               # searched in the host
    path: str               # searched in the path
    tokens: tuple[str, ...]
    listed: bool = False    # a rule of the caller's list, ahead of the general patterns


#: Most rules that travel to the executors; longer lists are joined.
SHORT_LIST = 10_000


def host_rule(verdict: str, place: str) -> Rule:
    """A rule ``host/path`` for the host and all its subdomains."""
    host, _, path = place.partition("/")
    tokens = tuple(t for t in re.split("[^a-z0-9]+", f"{host} {path}".lower()) if t)
    if path and not path.endswith("/"):
        tokens = tuple(t for t in re.split("[^a-z0-9]+", host) if t)  # the last path token may be cut short
    return Rule(place, verdict, rf"(?:\A|\.){re.escape(host)}\Z", rf"\A/{re.escape(path)}", tokens, True)


LISTED = (host_rule("block", "net/"), host_rule("allow", "example.net/en/"), host_rule("block", "example.com/de/"), host_rule("allow", "org/fr/"))

#: General patterns: adult, gambling and spam sites by host, sign-in and basket pages by path.
GENERAL = (
    Rule("adult", "block", r"(?:\A|[.-])adult[.-]", "", ("adult",)),
    Rule("casino", "block", r"(?:\A|[.-])casino[.-]", "", ("casino",)),
    Rule("poker", "block", r"(?:\A|[.-])poker[.-]", "", ("poker",)),
    Rule("spam", "block", r"(?:\A|[.-])spam[.-]", "", ("spam",)),
    Rule("wp_login", "block", "", r"\A/(?:[^ ]*/)?wp-login(?:\.php)?(?:/|\Z)", ("wp", "login")),
    Rule("cart", "block", "", r"\A/(?:[^ ]*/)?cart/", ("cart",)),
)


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def url_tokens() -> Column:
    """Distinct runs of ASCII letters and digits of ``host`` and ``path``, lower-cased, and "", which rules without a token are under."""
    return F.array_distinct(F.split(F.concat(F.lit(" "), F.translate(F.concat_ws(" ", "host", "path"), UPPER, LOWER)), "[^a-z0-9]+"))


def token_index(urls: DataFrame, rules: tuple[Rule, ...]) -> dict[str, list[int]]:
    """Rule numbers by the rarest token of each rule; rules without tokens are under "" and always run.

    Token counts cover all of ``urls``; only the tokens that rules name reach the driver.
    """
    wanted = sorted({t for r in rules for t in r.tokens})
    named = F.array_intersect(url_tokens(), F.array(*map(F.lit, wanted)).cast("array<string>"))
    counts = dict(urls.select(F.explode(named).alias("token")).groupBy("token").count().collect()) if wanted else {}
    index: dict[str, list[int]] = defaultdict(list)
    for number, rule in enumerate(rules):
        index[min(rule.tokens, key=lambda t: (counts.get(t, 0), -len(t), t)) if rule.tokens else ""].append(number)
    return dict(index)


@lru_cache(maxsize=4096)
def _compiled(pattern: str) -> re.Pattern:
    return re.compile(pattern)


def _fits(host_pattern: str, path_pattern: str, host: str, path: str) -> bool:
    return bool(_compiled(host_pattern).search(host) and _compiled(path_pattern).search(path))


def _ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def judge(pages: DataFrame, listed: tuple[Rule, ...] = LISTED, general: tuple[Rule, ...] = GENERAL) -> DataFrame:
    """``page_id, host, path, rule, verdict, pattern``, one row for each row of ``pages``.

    Of the listed rules that fit a URL the longest decides (the first listed of equally long ones); else
    any general pattern that fits blocks it, and its name is in ``pattern``; else it is allowed.  A NULL
    URL or one without ``://`` has an empty host and path and is allowed.  URLs are looked at whole, however long;
    columns other than ``page_id`` and ``url`` may have any name.
    """
    rules = (*listed, *general)
    if len(rules) > SHORT_LIST:
        return judge_by_table(pages, rule_table(pages.sparkSession, rules))
    host, path = parts(F.col("url"))
    urls = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    index = token_index(urls, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        always = index.get("", [])
        for batch in batches:
            out = []
            for host, path in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                tokens = set(re.split("[^a-z0-9]+", _ascii_lower(f"{host} {path}")))
                fetched = {n for t in tokens if t for n in index.get(t, ())}
                fits = [rules[n] for n in sorted({*fetched, *always}) if _fits(rules[n].host, rules[n].path, host, path)]
                mine = max((r for r in fits if r.listed), key=lambda r: len(r.name), default=None)
                other = next((r for r in fits if not r.listed), None)
                decided = mine or other
                out.append((mine.name if mine else None, decided.verdict if decided else "allow", other.name if other else None))
            made = [pa.array(c, pa.string()) for c in (zip(*out) if out else [[]] * 3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *made],
                                             ["page_id", "host", "path", "rule", "verdict", "pattern"])

    kind = dict(urls.dtypes)["page_id"]
    return urls.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string, pattern string")


RULES = "number long, name string, verdict string, host_pattern string, path_pattern string, tokens array<string>, listed boolean"


def rule_table(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame:
    return spark.createDataFrame([(i, r.name, r.verdict, r.host, r.path, list(r.tokens), r.listed) for i, r in enumerate(rules)], RULES)


def judge_by_table(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """The same for a table of rules of any length: ``number, name, verdict, host_pattern, path_pattern, tokens, listed``.

    ``number`` orders the rules.  Rules and URLs meet under one token of the rule, the rarest
    over all URLs; URLs are numbered where they are written, so repeated pages stay apart.
    """
    host, path = parts(F.col("url"))
    urls = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    urls = stored(urls.withColumn("row", F.monotonically_increasing_id()), "urls")
    rules = stored(rules.select(*(c.split(" ")[0] for c in RULES.split(", "))), "rules")
    held = urls.select("row", F.explode(url_tokens()).alias("token"))
    named = rules.select("number", F.explode(F.when(F.size("tokens") > 0, F.col("tokens")).otherwise(F.array(F.lit("")))).alias("token"))
    counts = held.join(named.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    filed = named.join(counts, "token", "left").groupBy("number").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), (-F.length("token")).alias("longest"), "token")).alias("rarest"))
    filed = rules.join(filed.select("number", F.col("rarest.token").alias("token")), "number").drop("tokens")
    met = held.join(filed, "token").join(urls.select("row", "host", "path"), "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [_fits(*row) for row in zip(*(batch.column(i).to_pylist() for i in range(5, 9)))]
            yield batch.select([0, 1, 2, 3, 4]).filter(pa.array(ok, pa.bool_()))

    fits = met.select("row", "number", "name", "verdict", "listed", "host_pattern", "path_pattern", "host", "path").mapInArrow(
        run, "row long, number long, name string, verdict string, listed boolean")
    found = fits.groupBy("row").agg(
        F.max(F.when(F.col("listed"), F.struct(F.length("name").alias("size"), (-F.col("number")).alias("first"), "name", "verdict"))).alias("mine"),
        F.min(F.when(~F.col("listed"), F.struct("number", "name", "verdict"))).alias("other"))
    out = urls.join(found, "row", "left")
    return out.select("page_id", "host", "path", F.col("mine.name").alias("rule"),
                      F.coalesce("mine.verdict", "other.verdict", F.lit("allow")).alias("verdict"), F.col("other.name").alias("pattern"))
