"""Normalising, checksums, numbering, chunks and motif scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.checksums import decode_id, encode_id
from ..operators import ordered, sequences
from . import bindings as B
from .registry import job

LETTERS = ("let AS (SELECT doc_id, source, regexp_replace(text, '[^A-Za-z*.\\-]', '', 'g') AS raw FROM documents), "
           "seqs AS (SELECT doc_id, source, translate(upper(rtrim(regexp_replace(raw, '[-.]', '', 'g'), '*')), "
           "'*JBZUO', 'XXXXXX') AS seq FROM let)")
CHECKSUM = "rtrim(to_base64(unhex(sha1(upper(seq)))), '=')"


@job("seq_normalise", f"WITH {LETTERS} SELECT doc_id, seq FROM seqs")
def seq_normalise(spark, sf):
    return B.letters(spark, sf).select("doc_id", sequences.normalise(F.col("seq")).alias("seq"))


@job("seq_invalid", "SELECT doc_id, regexp_matches(text, '^[^A-Za-z]') AS first_bad, regexp_matches(text, '[^A-Za-z]') "
     "AS any_bad FROM documents")
def seq_invalid(spark, sf):
    return B.table(spark, sf, "documents").select(
        "doc_id", sequences.invalid(F.col("text")).alias("first_bad"),
        sequences.invalid(F.col("text"), strict=True).alias("any_bad"))


@job("seq_checksum", f"WITH {LETTERS} SELECT doc_id, {CHECKSUM} AS checksum, md5(seq) AS md5sum FROM seqs")
def seq_checksum(spark, sf):
    rows = B.letters(spark, sf).withColumn("seq", sequences.normalise(F.col("seq")))
    return sequences.with_checksums(rows).select("doc_id", "checksum", "md5sum")


@job("dedup_encode", f"WITH {LETTERS}, c AS (SELECT doc_id, {CHECKSUM} AS checksum, md5(seq) AS md5sum FROM seqs), "
     "f AS (SELECT checksum, min(doc_id) AS first FROM c GROUP BY 1), n AS (SELECT checksum, row_number() OVER "
     "(ORDER BY first) - 1 AS n FROM f) SELECT doc_id, 'SR' || to_base(n, 36, 5) AS encoded, checksum, md5sum "
     "FROM c JOIN n USING (checksum)")
def dedup_encode(spark, sf):
    rows = B.letters(spark, sf).select("doc_id", "seq")
    out = sequences.dedup_encode(rows, ["doc_id"])
    return out.select("doc_id", "encoded", "checksum", "md5sum")


@job("decode_id", "SELECT o_orderkey, 'S' || to_base(o_orderkey, 36, 3) AS code, o_orderkey AS number FROM orders")
def decode_id_job(spark, sf):
    code = encode_id(F.col("o_orderkey"), "S", 3)
    return B.table(spark, sf, "orders").select("o_orderkey", code.alias("code")).withColumn(
        "number", decode_id(F.col("code"), "S"))


@job("chunk", "SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) // 30 + 1 AS BIGINT) AS chunk FROM documents")
def chunk(spark, sf):
    rows = B.table(spark, sf, "documents").select("doc_id")
    return sequences.chunk(rows, ["doc_id"], size=30)


def _scan_sql(patterns: list[str], kind: str, shown: list[str] | None = None) -> str:
    parts = []
    for i, x in enumerate(patterns):
        label = (shown or patterns)[i]
        parts.append(
            f"SELECT doc_id, '{label}' AS pattern, generate_subscripts(m, 1) AS i, unnest(m) AS match, "
            f"unnest(list_slice(b, 1, len(m))) AS before FROM (SELECT doc_id, regexp_extract_all(s, '{x}') AS m, "
            f"string_split_regex(s, '{x}') AS b FROM res_seq)")
    union = " UNION ALL ".join(parts)
    return (
        "WITH res_seq AS (SELECT doc_id, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS s FROM documents), "
        f"hits AS ({union}), ends AS (SELECT *, CAST(SUM(length(before) + length(match)) OVER (PARTITION BY doc_id, pattern "
        "ORDER BY i) AS INT) AS \"end\" FROM hits) SELECT CAST(doc_id AS STRING) AS name, "
        f"'{kind}' AS kind, pattern, match, CAST(\"end\" - length(match) AS INT) AS start, \"end\" FROM ends")


KEX2 = ["[KR]R", "L[A-Z][A-Z]R", "[LIJVAP][A-Z][KRTPEI]R"]
RXLR = ["[RKH][A-Z][LMIFYW][A-Z]"]


@job("motif_scan", _scan_sql(RXLR, "rxlr_like_motif"))
def motif_scan(spark, sf):
    return sequences.scan_motifs(B.residues(spark, sf), "rxlr_like_motif")


@job("motif_scan_multi", _scan_sql(KEX2, "kex2_cutsite"))
def motif_scan_multi(spark, sf):
    return sequences.scan_motifs(B.residues(spark, sf), "kex2_cutsite")


@job("motif_scan_custom", _scan_sql(["(?i)the[a-z]{2}r"], "custom", ["the[a-z]{2}r"]))
def motif_scan_custom(spark, sf):
    return sequences.scan_motifs(B.residues(spark, sf), "custom", "the[a-z]{2}r")


@job("run_length", f"WITH {B.EVENTS_SQL}, r AS (SELECT u, event_type, row_number() OVER (PARTITION BY u ORDER BY ts, e) - 1 "
     "AS i, row_number() OVER (PARTITION BY u, event_type ORDER BY ts, e) AS j FROM ev) SELECT u, event_type AS symbol, "
     "min(i) AS start, max(i) + 1 AS \"end\" FROM r GROUP BY u, event_type, i - j")
def run_length(spark, sf):
    rows = B.events(spark, sf).select("u", "event_type", "ts", "e")
    return ordered.runs(rows, ["u"], ["ts", "e"], "event_type")
