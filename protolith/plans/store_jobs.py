"""Loading, selecting, comparing and decoding stored results."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..analyses import ANALYSES
from ..functions.checksums import record_checksum
from ..functions.topology import summary_text
from ..operators import projection, store
from ..operators.features import with_running_id
from ..session import scratch
from ..sinks import writers
from ..sources.results import parse_results
from . import bindings as B
from .bindings import payload_sql as p
from .registry import job

RES = f"WITH {B.RESULTS_SQL}"
DATA = "'{\"k\":' || CAST(k AS STRING) || '}'"
PLAIN = f"{RES}, plain AS (SELECT *, {DATA} AS data FROM res)"
DB = "CASE WHEN analysis IN " + B.DB_LIST + " THEN {c} END AS {c}"
COLS = ("analysis, software, software_version, database, database_version, pipeline_version, checksum, md5sum, data")
COLS_NO_MD5 = COLS.replace("md5sum, ", "")


def _conflict_data() -> str:
    """Payload text of the kinds that keep several rows, as far as it varies."""
    cases = []
    for a in ANALYSES.values():
        if a.multiple_ok:
            fields = " || '|' || ".join(f"COALESCE(CAST({p(a.name, f)} AS STRING), '')" for f in B.PAYLOADS[a.name])
            cases.append(f"WHEN '{a.name}' THEN {fields}")
    return f"CASE analysis {' '.join(cases)} ELSE '' END"


_KEYED = (
    f"{RES}, keyed AS (SELECT *, {_conflict_data()} AS dk, COALESCE(database_version, '') AS dv FROM res "
    f"WHERE analysis <> 'deeploc' AND NOT (analysis IN {B.DB_LIST} AND database_version IS NULL))")
_LOADED = (
    f"{_KEYED}, old AS (SELECT DISTINCT analysis, software_version, dv, checksum, dk FROM keyed WHERE event_type = 'view'), "
    "fresh AS (SELECT *, row_number() OVER (PARTITION BY analysis, software_version, dv, checksum, dk ORDER BY e) AS rn "
    "FROM keyed WHERE event_type <> 'view') ")


@job("load_results", f"{_LOADED} SELECT e, analysis, checksum, md5sum, name, software_version, database_version "
     "FROM fresh f WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM old o WHERE o.analysis = f.analysis "
     "AND o.software_version = f.software_version AND o.dv = f.dv AND o.checksum = f.checksum AND o.dk = f.dk)")
def load_results(spark, sf):
    """Results of one event type are the store; the others arrive as JSON lines."""
    options = {"exclude": ["deeploc"], "drop_null_dbversion": True}
    path = scratch(spark, "incoming")
    B.results(spark, sf).select("e", "event_type", *store.RESULT_COLUMNS).write.mode("overwrite").json(path)
    lines = spark.read.text(path).withColumn("e", F.get_json_object("value", "$.e").cast("bigint")).withColumn(
        "is_old", F.get_json_object("value", "$.event_type") == "view")
    parsed = parse_results(lines).filter("problem IS NULL").drop("problem")
    held = store.load_results(parsed.filter("is_old"), ["e"], **options)
    arrived = parsed.filter("NOT is_old")
    return store.load_results(arrived, ["e"], store=held, **options).select(
        "e", "analysis", "checksum", "md5sum", "name", "software_version", "database_version")


@job("build_decoder", f"{RES} SELECT DISTINCT checksum, md5sum, event_type AS filename, name FROM res")
def build_decoder(spark, sf):
    return store.build_decoder(B.plain_results(spark, sf).withColumn("filename", F.col("event_type")))


@job("select_all", f"{PLAIN} SELECT DISTINCT {COLS} FROM plain WHERE checksum IN "
     "(SELECT 'S' || CAST(c_custkey AS STRING) FROM customer WHERE c_mktsegment <> 'MACHINERY')")
def select_all(spark, sf):
    keys = B.decoder(spark, sf).filter("filename <> 'MACHINERY'")
    return store.select_all(B.plain_results(spark, sf), keys)


@job("rank_view", f"{PLAIN}, {B.DECODER_SQL} SELECT DISTINCT {COLS_NO_MD5}, d.name FROM plain "
     "JOIN (SELECT checksum, name FROM decoder) d USING (checksum)".replace(
         COLS_NO_MD5, COLS_NO_MD5))
def rank_view(spark, sf):
    return store.rank_view(B.plain_results(spark, sf), B.decoder(spark, sf))


@job("fetch_targets", f"{RES} SELECT DISTINCT analysis, software_version, database_version FROM res")
def fetch_targets(spark, sf):
    return store.fetch_targets(B.plain_results(spark, sf))


@job("version_conflicts", f"{RES} SELECT analysis, COUNT(*) AS n_versions FROM (SELECT DISTINCT analysis, "
     "software_version, database_version FROM res) GROUP BY 1 HAVING COUNT(*) > 1")
def version_conflicts(spark, sf):
    return store.version_conflicts(B.plain_results(spark, sf))


_TARGETS = ("targets AS (SELECT DISTINCT analysis, software_version, database_version FROM res "
            f"WHERE software_version = '2.0' AND NOT (analysis IN {B.DB_LIST} AND database_version IS NULL))")


def _targets(spark, sf):
    wanted = store.fetch_targets(B.plain_results(spark, sf)).filter("software_version = '2.0'")
    return store.usable_targets(wanted)


@job("select_target", f"{PLAIN}, {_TARGETS} SELECT e, {COLS} FROM plain WHERE EXISTS (SELECT 1 FROM targets t "
     "WHERE t.analysis = plain.analysis AND t.software_version = plain.software_version AND "
     f"(plain.analysis NOT IN {B.DB_LIST} OR COALESCE(t.database_version, '') = COALESCE(plain.database_version, ''))) "
     "AND checksum IN (SELECT 'S' || CAST(c_custkey AS STRING) FROM customer WHERE c_mktsegment <> 'MACHINERY')")
def select_target(spark, sf):
    keys = B.decoder(spark, sf).filter("filename <> 'MACHINERY'")
    return store.select_target(B.plain_results(spark, sf), _targets(spark, sf), keys).select(
        "e", *store.RESULT_COLUMNS)


@job("select_target_store", f"{PLAIN}, {_TARGETS} SELECT {COLS} FROM (SELECT *, row_number() OVER (PARTITION BY analysis, "
     "software_version, COALESCE(database_version, ''), checksum, md5sum, CASE WHEN analysis IN " + B.MULTI_LIST + " THEN data ELSE '' END ORDER BY e % 2, e) AS rn "
     "FROM plain) p WHERE rn = 1 AND EXISTS (SELECT 1 FROM targets t "
     "WHERE t.analysis = p.analysis AND t.software_version = p.software_version AND "
     f"(p.analysis NOT IN {B.DB_LIST} OR COALESCE(t.database_version, '') = COALESCE(p.database_version, ''))) "
     "AND checksum IN (SELECT 'S' || CAST(c_custkey AS STRING) FROM customer WHERE c_mktsegment <> 'MACHINERY')")
def select_target_store(spark, sf):
    """The same question to a store on disk, filled in two appends."""
    path = scratch(spark, "store")
    rows = B.plain_results(spark, sf)
    store.append_store(store.keep_first(rows.filter("e % 2 = 0"), ["e"]), path)
    store.append_store(store.keep_first(rows, ["e"], store.read_store(spark, path)), path)
    keys = B.decoder(spark, sf).filter("filename <> 'MACHINERY'")
    return store.select_target(store.read_store(spark, path), _targets(spark, sf), keys).select(*store.RESULT_COLUMNS)


_REMAINING = (
    f"{RES}, {_TARGETS}, have AS (SELECT DISTINCT analysis, software_version, COALESCE(database_version, '') AS dv, "
    "checksum FROM res), left_over AS (SELECT t.analysis, t.software_version, t.database_version, "
    "'S' || CAST(c.c_custkey AS STRING) AS checksum, c.c_name AS id, c.c_mktsegment AS seq FROM targets t, customer c "
    "WHERE NOT EXISTS (SELECT 1 FROM have h WHERE h.analysis = t.analysis AND h.software_version = t.software_version "
    "AND h.dv = COALESCE(t.database_version, '') AND h.checksum = 'S' || CAST(c.c_custkey AS STRING)))")


def _remaining(spark, sf):
    return store.find_remaining(B.plain_results(spark, sf), _targets(spark, sf), B.decoder(spark, sf))


@job("find_remaining", f"{_REMAINING} SELECT analysis, software_version, database_version, checksum FROM left_over")
def find_remaining(spark, sf):
    return _remaining(spark, sf)


@job("remaining_sequences", f"{_REMAINING} SELECT analysis, software_version, database_version, id, seq FROM left_over")
def remaining_sequences(spark, sf):
    sequences = B.decoder(spark, sf).selectExpr("checksum", "name AS id", "filename AS seq")
    return store.remaining_sequences(_remaining(spark, sf), sequences).select(
        "analysis", "software_version", "database_version", "id", "seq")


@job("select_by_key", f"{PLAIN} SELECT DISTINCT {COLS} FROM plain WHERE md5sum IN "
     "(SELECT 'M' || CAST(c_custkey AS STRING) FROM customer WHERE c_mktsegment = 'BUILDING')")
def select_by_key(spark, sf):
    keys = B.decoder(spark, sf).filter("filename = 'BUILDING'")
    return store.select_by_key(B.plain_results(spark, sf), keys, "md5sum")


_DECODED = (
    f"{PLAIN}, {B.WIDE_DECODER_SQL}, decoded AS (SELECT DISTINCT {COLS_NO_MD5}, d.md5sum, d.name, d.filename FROM "
    f"(SELECT {COLS_NO_MD5} FROM plain) r JOIN decoder d USING (checksum) WHERE d.filename IS NOT NULL)")


@job("decode", f"{_DECODED} SELECT * FROM decoded")
def decode(spark, sf):
    return store.decode(B.plain_results(spark, sf), B.wide_decoder(spark, sf))


_TABLE_KINDS = ("phobius", "deepsig", "kex2_cutsite", "localizer", "pfamscan")


def _table_fields(kind):
    skip = ("name", "prob", "chloroplast_prob", "mitochondria_prob", "bitscore", "evalue")
    return [f for f in B.PAYLOADS[kind] if f not in skip]


def _table_sql(kind):
    return " UNION ALL ".join(
        f"SELECT d.name, '{kind}' AS analysis, '{f}' AS parameter, CAST({p(kind, f)} AS STRING) AS value "
        f"FROM res JOIN decoder d USING (checksum) WHERE analysis = '{kind}'" for f in _table_fields(kind))


@job("analysis_tables", f"{RES}, {B.DECODER_SQL} " + " UNION ALL ".join(_table_sql(k) for k in _TABLE_KINDS))
def analysis_tables(spark, sf):
    """Typed tables of several kinds, stacked as long rows so one check covers them."""
    rows, names = B.results(spark, sf), B.decoder(spark, sf)
    out = None
    for kind in _TABLE_KINDS:
        table = store.analysis_table(rows, kind, names)
        long = store.melt(table, ANALYSES[kind].name_column, _table_fields(kind), kind)
        out = long if out is None else out.unionByName(long)
    return out


@job("attach_checksums", f"WITH {B.EVENTS_SQL}, last AS (SELECT o_custkey AS u, 'S' || CAST(max(o_orderkey) AS STRING) "
     "AS checksum, 'M' || CAST(max(o_orderkey) AS STRING) AS md5sum FROM orders GROUP BY 1) "
     "SELECT e, 'U' || CAST(u AS STRING) AS name, checksum, md5sum FROM ev LEFT JOIN last USING (u)")
def attach_checksums(spark, sf):
    """Sequence ids repeat, and some event users have none."""
    rows = B.events(spark, sf).selectExpr("e", "'U' || CAST(u AS STRING) AS name")
    sequences = B.table(spark, sf, "orders").selectExpr(
        "'U' || CAST(o_custkey AS STRING) AS id", "'S' || CAST(o_orderkey AS STRING) AS checksum",
        "'M' || CAST(o_orderkey AS STRING) AS md5sum", "o_orderkey AS ordinal")
    return store.attach_checksums(rows, sequences)


@job("record_checksum", f"WITH {B.EVENTS_SQL} SELECT e, rtrim(to_base64(unhex(sha256('{{\"name\":\"P' || CAST(u AS STRING) "
     "|| '\",\"event_type\":\"' || event_type || '\",\"k\":' || CAST(k AS STRING) || '}'))), '=') AS checksum FROM ev")
def record_checksum_job(spark, sf):
    payload = F.to_json(F.struct(F.concat(F.lit("P"), F.col("u")).alias("name"), "event_type", "k"))
    return B.events(spark, sf).select("e", record_checksum(payload).alias("checksum"))


@job("empty_result_check", f"WITH {B.EVENTS_SQL} SELECT (SELECT COUNT(*) FROM customer) AS n_sequences, "
     "(SELECT COUNT(*) FROM ev WHERE k > 1000) AS n_records, TRUE AS failed")
def empty_result_check(spark, sf):
    return store.empty_result_check(B.decoder(spark, sf), B.events(spark, sf).filter("k > 1000"))


@job("running_id", f"{RES} SELECT e, analysis, row_number() OVER (PARTITION BY analysis ORDER BY e) AS running_id FROM res")
def running_id(spark, sf):
    rows = B.plain_results(spark, sf).select("e", "analysis")
    return with_running_id(rows, ["e"])


@job("melt", "SELECT CAST(p_partkey AS STRING) AS name, 'part' AS analysis, parameter, value FROM (SELECT p_partkey, "
     "p_name, p_brand, p_type, CAST(p_size AS STRING) AS p_size FROM part) UNPIVOT INCLUDE NULLS "
     "(value FOR parameter IN (p_name, p_brand, p_type, p_size))")
def melt(spark, sf):
    rows = B.table(spark, sf, "part").withColumn("p_partkey", F.col("p_partkey").cast("string"))
    return store.melt(rows, "p_partkey", ["p_name", "p_brand", "p_type", "p_size"], "part")


@job("conditional_group_filter", f"WITH {B.EVENTS_SQL}, g AS (SELECT *, u * 100 + k AS g FROM ev) SELECT e, g, event_type "
     "FROM g WHERE event_type <> 'error' OR g IN (SELECT g FROM g WHERE event_type = 'signup')")
def conditional_group_filter(spark, sf):
    rows = B.events(spark, sf).selectExpr("e", "u * 100 + k AS g", "event_type")
    return projection.drop_lonely_cuts(rows, "g", "event_type", "signup", "error")


@job("relabel_source", f"WITH {B.EVENTS_SQL} SELECT e, CASE WHEN k % 3 = 0 THEN CASE WHEN k % 2 = 0 THEN 'SignalPNN:3.0b' "
     "ELSE 'SignalPHMM:3.0b' END ELSE 'SignalP:4.1' END AS source FROM ev")
def relabel_source(spark, sf):
    custom = F.when(F.col("k") % 2 == 0, F.create_map(F.lit("d_decision"), F.lit("Y"))).otherwise(
        F.create_map(F.lit("cmax"), F.lit("1")))
    source = F.when(F.col("k") % 3 == 0, "SignalP:3.0b").otherwise("SignalP:4.1")
    return B.events(spark, sf).select("e", projection.relabel(source, custom).alias("source"))


@job("snk_partitioned", f"{_DECODED} SELECT filename, COUNT(*) AS n FROM decoded GROUP BY 1")
def snk_partitioned(spark, sf):
    """Decoded results written one folder per original file, then counted per folder."""
    path = scratch(spark, "decoded")
    decoded = store.decode(B.plain_results(spark, sf), B.wide_decoder(spark, sf))
    writers.write_ldjson(decoded, path, ["filename"])
    return spark.read.text(path).groupBy(F.col("filename").cast("string").alias("filename")).agg(
        F.count(F.lit(1)).alias("n"))


@job("snk_ldjson", f"{PLAIN} SELECT DISTINCT {COLS}, name FROM plain")
def snk_ldjson(spark, sf):
    """The whole store written as JSON lines and read back."""
    path = scratch(spark, "ldjson")
    rows = B.plain_results(spark, sf)
    writers.write_ldjson(rows.select(*store.RESULT_COLUMNS, "name").distinct(), path)
    back = parse_results(spark.read.text(path)).filter("problem IS NULL")
    # the writer puts the name back into the payload
    name = store.record_name(F.col("analysis"), F.col("data"))
    k = F.concat(F.lit('{"k":'), F.get_json_object("data", "$.k"), F.lit("}"))
    return back.withColumn("name", name).withColumn("data", k).select(*store.RESULT_COLUMNS, "name")


@job("src_ldjson", f"{PLAIN} SELECT analysis, software_version, database_version, checksum, data, "
     "CASE WHEN k % 9 = 0 THEN 'analysis' END AS problem FROM plain")
def src_ldjson(spark, sf):
    """Envelopes with some unknown kinds; those go aside with the reason."""
    rows = B.plain_results(spark, sf).withColumn("real", F.col("analysis")).withColumn(
        "analysis", F.when(F.col("k") % 9 == 0, "unheard_of").otherwise(F.col("analysis")))
    path = scratch(spark, "envelopes")
    rows.select("real", *store.RESULT_COLUMNS).write.mode("overwrite").json(path)
    lines = spark.read.text(path).withColumn("real", F.get_json_object("value", "$.real"))
    return parse_results(lines).select(
        F.col("real").alias("analysis"), "software_version", "database_version", "checksum", "data", "problem")


@job("drop_name", f"{RES} SELECT e, analysis, NULL AS name, FALSE AS in_payload FROM res")
def drop_name(spark, sf):
    """Payloads without their names."""
    rows = store.prepare(B.results(spark, sf), drop_name=True)
    named = F.get_json_object("data", "$.name").isNotNull() | F.get_json_object("data", "$.query").isNotNull()
    return rows.select("e", "analysis", "name", named.alias("in_payload"))


@job("topology_text", f"{RES} SELECT e, CASE WHEN k > 0 THEN 'sp:1-' || CAST(k AS STRING) || '|' ELSE '' END || 'tm:' || CAST(k + 6 AS STRING) || '-' "
     "|| CAST(k + 20 AS STRING) || CASE WHEN k > 0 THEN ',' || CAST(k + 21 AS STRING) || '-' || CAST(k + 20 + k AS STRING) ELSE '' END AS topology "
     "FROM res WHERE analysis = 'tmbed'")
def topology_text(spark, sf):
    rows = B.results(spark, sf).filter("analysis = 'tmbed'")
    return rows.select("e", summary_text(F.get_json_object("data", "$.topology")).alias("topology"))
