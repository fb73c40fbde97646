"""How the driver tables stand in for annotation data.

Every table is used whole.  A binding is a set of expressions in the SQL that
Spark and DuckDB share, so a check reads the same inputs and only the operator
under test differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..analyses import ANALYSES, MULTIPLE_OK, NEEDS_DATABASE

# event fields: e event_id, u user_id, v value, k integer 0..99
_KEX2 = "CASE k % 3 WHEN 0 THEN '[KR]R' WHEN 1 THEN 'L[A-Z][A-Z]R' ELSE '[LIJVAP][A-Z][KRTPEI]R' END"
_SIGNAL5 = "CASE WHEN k >= 50 THEN 'CS pos: ' || CAST(k AS STRING) || '-' || CAST(k + 1 AS STRING) || '. VLA-AP. Pr: 0.9' END"
_SIGNAL6 = "CASE WHEN k >= 50 THEN 'CS pos: ' || CAST(k AS STRING) || '-' || CAST(k + 1 AS STRING) || '. Pr: 0.9' END"
_PHENOTYPE = (
    "CASE k % 5 WHEN 0 THEN 'Lethal' WHEN 1 THEN 'reduced_virulence__lethal' "
    "WHEN 2 THEN 'loss_of_pathogenicity' WHEN 3 THEN 'unaffected_pathogenicity' "
    "ELSE 'reduced_virulence' END"
)
_P = "k / 1e2"
_DOMAIN = {
    "hmm_len": "100", "query_len": "200", "full_evalue": "k / 1e6", "full_score": "v", "full_bias": "0.5e0",
    "nmatches": "1", "domain_c_evalue": "k / 1e6", "domain_i_evalue": "(k % 13) / 1e4", "domain_score": "v",
    "domain_bias": "0.1e0", "hmm_from": "0", "hmm_to": "k", "query_from": "k",
    "query_to": "k + CASE WHEN k % 2 = 0 THEN 100 ELSE 50 END", "acc": "0.9e0",
}

PAYLOADS: dict[str, dict[str, str]] = {
    "signalp3_nn": {
        "cmax": _P, "cmax_pos": "k + 1", "cmax_decision": "k % 2 = 0", "ymax_pos": "k + 2",
        "d": _P, "d_decision": "k >= 50"},
    "signalp3_hmm": {"is_secreted": "k >= 40", "cmax": _P, "cmax_pos": "k + 3", "sprob": _P},
    "signalp4": {"cmax": _P, "ymax_pos": "k + 2", "d": "v / 1e3", "decision": "k >= 60"},
    "signalp5": {
        "prediction": "CASE WHEN k >= 50 THEN 'SP(Sec/SPI)' ELSE 'OTHER' END", "prob_signal": "v / 5e1",
        "prob_other": "1 - k / 1e2", "cs_pos": _SIGNAL5},
    "signalp6": {
        "prediction": "CASE WHEN k >= 50 THEN 'SP' ELSE 'OTHER' END", "prob_signal": _P,
        "prob_other": "1 - k / 1e2", "cs_pos": _SIGNAL6},
    "deepsig": {
        "prediction": "CASE k % 3 WHEN 0 THEN 'SignalPeptide' WHEN 1 THEN 'Transmembrane' ELSE 'Other' END",
        "prob": _P, "cs_pos": "CASE WHEN k % 3 = 0 THEN k + 1 END"},
    "phobius": {
        "tm": "k % 4", "sp": "k % 2 = 0",
        "topology": (
            "CASE WHEN k % 2 = 0 THEN 'n4-' || CAST(k + 10 AS STRING) || 'c' || CAST(k + 15 AS STRING) || '/' "
            "|| CAST(k + 16 AS STRING) ELSE '' END || 'o' || CAST(k + 30 AS STRING) || '-' "
            "|| CAST(k + 50 AS STRING) || 'i'")},
    "tmhmm": {
        "length": "200", "exp_aa": "v", "first_60": "k / 5e0", "pred_hel": "k % 3",
        "topology": (
            "CASE WHEN k % 3 = 0 THEN 'o' ELSE 'i' || CAST(k + 5 AS STRING) || '-' "
            "|| CAST(k + 25 AS STRING) || 'o' END")},
    "deeploc": {
        "prediction": "'Nucleus'", "membrane": _P, "nucleus": "v / 1e2", "cytoplasm": "k / 2e2",
        "extracellular": "1 - k / 1e2", "mitochondrion": "k / 3e2", "cell_membrane": "k / 4e2",
        "endoplasmic_reticulum": "k / 5e2", "plastid": "k / 6e2", "golgi_apparatus": "k / 7e2",
        "lysosome_vacuole": "k / 8e2", "peroxisome": "k / 9e2"},
    "targetp_plant": {
        "prediction": "CASE WHEN k % 2 = 0 THEN 'SP' ELSE 'luTP' END", "other": _P, "sp": _P, "mtp": _P,
        "ctp": _P, "lutp": _P,
        "cs_pos": (
            "CASE WHEN k % 2 = 0 THEN 'CS pos: 20-' || CAST(k + 2 AS STRING) || '. ALA-SP. Pr: 0.5' "
            "ELSE 'CS pos luTP: 90-91. ALA-SP. Pr: 0.8; CS pos cTP: 41-' || CAST(k + 2 AS STRING) "
            "|| '. Pr: 0.7' END")},
    "targetp_non_plant": {
        "prediction": "CASE k % 3 WHEN 0 THEN 'SP' WHEN 1 THEN 'mTP' ELSE 'OTHER' END", "other": _P,
        "sp": "v / 5e1", "mtp": _P,
        "cs_pos": (
            "CASE WHEN k % 3 < 2 THEN 'CS pos: ' || CAST(k AS STRING) || '-' || CAST(k + 2 AS STRING) "
            "|| '. VLA-AP. Pr: 0.9' END")},
    "effectorp1": {"prediction": "CASE WHEN k % 2 = 0 THEN 'Effector' ELSE 'Non-effector' END", "prob": _P},
    "effectorp2": {
        "prediction": "CASE k % 3 WHEN 0 THEN 'Effector' WHEN 1 THEN 'Unlikely effector' ELSE 'Non-effector' END",
        "prob": _P},
    "apoplastp": {"prediction": "CASE WHEN k % 2 = 0 THEN 'Apoplastic' ELSE 'Non-apoplastic' END", "prob": _P},
    "localizer": {
        "chloroplast_decision": "k % 2 = 0", "chloroplast_prob": f"CASE WHEN k % 2 = 0 THEN {_P} END",
        "chloroplast_start": "CASE WHEN k % 2 = 0 THEN k + 19 END",
        "chloroplast_end": "CASE WHEN k % 2 = 0 THEN k + 49 END",
        "mitochondria_decision": "k % 3 = 0", "mitochondria_prob": f"CASE WHEN k % 3 = 0 THEN {_P} END",
        "mitochondria_start": "CASE WHEN k % 3 = 0 THEN k + 19 END",
        "mitochondria_end": "CASE WHEN k % 3 = 0 THEN k + 39 END",
        "nucleus_decision": "k % 5 = 0", "nucleus_signals": "CASE WHEN k % 5 = 0 THEN 'KKRK' END"},
    "pfamscan": {
        "ali_start": "k", "ali_end": "k + 40", "env_start": "k", "env_end": "k + 45",
        "hmm": "'PF' || CAST(k AS STRING)", "hmm_name": "'dom'", "hmm_type": "'Family'", "hmm_start": "1",
        "hmm_end": "40", "hmm_len": "44", "bitscore": "v", "evalue": "k / 1e6", "is_significant": "k % 2 = 0",
        "clan": "CASE WHEN k % 4 = 0 THEN 'CL1' END"},
    "dbcan": {
        "hmm": "CASE k % 5 WHEN 0 THEN 'CBM50' WHEN 1 THEN 'AA9' WHEN 2 THEN 'GH10' WHEN 3 THEN 'GT2' ELSE 'CE1' END",
        **_DOMAIN},
    "phibase": {
        "target": f"'acc#PHI:' || CAST(k AS STRING) || '#gene' || CAST(k % 7 AS STRING) || '#4.9#org#' || {_PHENOTYPE}",
        "qstart": "k", "qend": "k + 90", "qlen": "200", "tstart": "k", "tend": "k + 90", "tlen": "150",
        "evalue": "(k % 12) / 1e6", "gapopen": "0", "pident": "0.5e0", "alnlen": "90", "raw": "v", "bits": "v",
        "cigar": "'40M2D50M'", "mismatch": "3", "qcov": "0.4e0", "tcov": _P},
    "pepstats": {
        "molecular_weight": "v * 1e2", "residues": "100 + k", "charge": "k - 5e1",
        "isoelectric_point": f"CASE WHEN k % 10 < 9 THEN {_P} END",
        **{f"residue_{r}_number": f"(k + {i}) % 10" for i, r in enumerate("acfgiknpy")},
        **{f"property_{p}_number": f"(k * {i + 1}) % 50" for i, p in enumerate(
            ("tiny", "small", "aliphatic", "aromatic", "nonpolar", "polar", "charged", "basic", "acidic"))}},
    "effectordb": {"hmm": "'EFF' || CAST(k % 9 AS STRING)", **_DOMAIN},
    "effectorp3": {
        "prediction": "'Non-effector'", "cytoplasmic_prob": f"CASE WHEN k % 2 = 0 THEN {_P} END",
        "apoplastic_prob": f"CASE WHEN k % 3 = 0 THEN {_P} END",
        "noneffector_prob": f"CASE WHEN k % 5 = 0 THEN {_P} END"},
    "effectorp3_fungal": {"prediction": "'Non-effector'", "noneffector_prob": _P},
    "regexanalysis": {
        "kind": "'custom'", "pattern": "'R.L'", "match": "'RAL'", "start": "k", "end": "k + 3"},
    "deepredeff_fungi": {"s_score": _P, "prediction": "'effector'"},
    "deepredeff_oomycete": {"s_score": "v / 1e2", "prediction": "'effector'"},
    "deepredeff_bacteria": {"s_score": _P, "prediction": "'effector'"},
    "kex2_cutsite": {
        "kind": "'kex2_cutsite'", "pattern": _KEX2, "match": "CASE WHEN k < 50 THEN 'KR' ELSE 'RR' END",
        "start": "k % 20", "end": "k % 20 + 2"},
    "rxlr_like_motif": {
        "kind": "'rxlr_like_motif'", "pattern": "'[RKH][A-Z][LMIFYW][A-Z]'", "match": "'RALR'",
        "start": "k", "end": "k + 4"},
    "deeptmhmm": {
        "prediction": "'TM'", "topology": "repeat('S', k) || repeat('I', 3) || repeat('M', 20) || repeat('O', 2) || repeat('B', k)"},
    "deeploc2": {"cytoplasm": _P, "nucleus": _P},
    "tmbed": {
        "has_sp": "k > 10", "has_tm": "true", "topology": "repeat('S', k) || repeat('.', 5) || repeat('H', 15) || repeat('h', k)"},
}
assert set(PAYLOADS) == set(ANALYSES)

KIND = "CASE e % 31 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(PAYLOADS)) + " END"
DB_LIST = "(" + ", ".join(f"'{n}'" for n in NEEDS_DATABASE) + ")"
MULTI_LIST = "(" + ", ".join(f"'{n}'" for n in MULTIPLE_OK) + ")"
ENVELOPE = {
    "analysis": KIND,
    "software_version": "CASE WHEN e % 7 = 0 THEN '2.0' ELSE '1.0' END",
    "pipeline_version": "CASE WHEN e % 5 > 0 THEN 'p1' END",
    "checksum": "'S' || CAST(u AS STRING)",
    "md5sum": "'M' || CAST(u AS STRING)",
    "name": "'P' || CAST(u AS STRING)",
}
DATABASE_VERSION = f"CASE WHEN analysis IN {DB_LIST} AND k % 10 < 9 THEN 'r' || CAST(k % 2 AS STRING) END"
DATABASE = (
    "CASE analysis " + " ".join(
        f"WHEN '{a.name}' THEN '{a.database}'" for a in ANALYSES.values() if a.database) + " END")
SOFTWARE = "CASE analysis " + " ".join(f"WHEN '{a.name}' THEN '{a.software}'" for a in ANALYSES.values()) + " END"


# -- the Spark side ---------------------------------------------------------------
def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_id").alias("e"), F.col("user_id").alias("u"), F.col("value").alias("v"),
        F.get_json_object("props", "$.k").cast("int").alias("k"), "event_type", "ts")


def _envelopes(spark: SparkSession, sf: str) -> DataFrame:
    rows = events(spark, sf).selectExpr("*", *[f"{v} AS {c}" for c, v in ENVELOPE.items()])
    return rows.selectExpr(
        "*", f"{SOFTWARE} AS software", f"{DATABASE} AS database", f"{DATABASE_VERSION} AS database_version")


def results(spark: SparkSession, sf: str) -> DataFrame:
    """Result rows of all 31 kinds with full JSON payloads, made from the events."""
    rows = _envelopes(spark, sf)
    data = None
    for name, fields in PAYLOADS.items():
        a = ANALYSES[name]
        types = {f.name: f.dataType for f in a.schema.fields}
        payload = [F.col("name").alias(a.name_column)]
        payload += [F.expr(x).cast(types[f]).alias(f) for f, x in fields.items()]
        text = F.to_json(F.struct(*payload), {"ignoreNullFields": "false"})
        condition = F.col("analysis") == name
        data = F.when(condition, text) if data is None else data.when(condition, text)
    return rows.withColumn("data", data)


def plain_results(spark: SparkSession, sf: str) -> DataFrame:
    """The same envelopes with a payload that is easy to compare as text."""
    return _envelopes(spark, sf).withColumn(
        "data", F.concat(F.lit('{"k":'), F.col("k").cast("string"), F.lit("}")))


def decoder(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").selectExpr(
        "'S' || CAST(c_custkey AS STRING) AS checksum", "'M' || CAST(c_custkey AS STRING) AS md5sum",
        "c_mktsegment AS filename", "c_name AS name")


def wide_decoder(spark: SparkSession, sf: str) -> DataFrame:
    """Many names per checksum; some without a file."""
    return table(spark, sf, "orders").selectExpr(
        "'S' || CAST(o_custkey AS STRING) AS checksum", "'M' || CAST(o_custkey AS STRING) AS md5sum",
        "CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS filename",
        "'O' || CAST(o_orderkey AS STRING) AS name")


def letters(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents as sequences: letters and gap/stop signs, ASCII only."""
    return table(spark, sf, "documents").select(
        F.col("doc_id"), F.col("doc_id").cast("string").alias("id"), F.col("source").alias("filename"),
        F.regexp_replace("text", r"[^A-Za-z*.\-]", "").alias("seq"))


def residues(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents as upper-case letter strings."""
    return table(spark, sf, "documents").select(
        F.col("doc_id"), F.col("doc_id").cast("string").alias("id"),
        F.upper(F.regexp_replace("text", "[^A-Za-z]", "")).alias("seq"))


ROWS_PER_TASK = 125_000


def _lines_by_order(spark: SparkSession, sf: str) -> DataFrame:
    """Lines dealt by order: what is grouped or joined by order later stays where it is."""
    lines = table(spark, sf, "lineitem")
    # the number of parts follows the rows, so a task's hash maps do not grow with the table
    parts = max(spark.sparkContext.defaultParallelism, -(-lines.count() // ROWS_PER_TASK))
    return lines.repartition(parts, "l_orderkey")


def exons(spark: SparkSession, sf: str) -> DataFrame:
    """One exon per (order, line number), 1000 apart, as long as the largest quantity."""
    return _lines_by_order(spark, sf).groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_quantity").cast("int").alias("n")).selectExpr(
        "l_orderkey AS id", "'chr' || CAST(l_orderkey % 5 AS STRING) AS seqid",
        "CASE WHEN l_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand", "'src' AS source",
        "l_linenumber * 1000 AS start", "l_linenumber * 1000 + n AS end")


def order_features(spark: SparkSession, sf: str) -> DataFrame:
    """One feature of 15 residues per order."""
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS id", "o_orderkey AS feature_id", "CAST(o_orderkey % 40 AS INT) AS p_start",
        "CAST(o_orderkey % 40 + 15 AS INT) AS p_end")


LINE_FEATURE_TYPE = (
    "CASE WHEN l_linenumber <= 2 THEN 'signal_peptide' WHEN l_linenumber <= 4 THEN 'protein_match' "
    "WHEN l_linenumber = 5 THEN 'propeptide_cleavage_site' "
    "WHEN l_linenumber = 6 THEN 'transmembrane_polypeptide_region' ELSE 'n_terminal_region' END"
)


def line_features(spark: SparkSession, sf: str) -> DataFrame:
    """Up to seven typed features per order."""
    # the least flag only matters as before, at or after A; least numbers are kept in a hash map, least texts need sorted rows
    flag = F.expr("CASE WHEN l_returnflag < 'A' THEN 0 WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag > 'A' THEN 2 END")
    return _lines_by_order(spark, sf).groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_partkey").alias("pk"), F.min(flag).alias("flag")).selectExpr(
        "l_orderkey AS id", "l_orderkey * 10 + l_linenumber AS feature_id", f"{LINE_FEATURE_TYPE} AS type",
        "CASE WHEN flag = 1 THEN 'toolA' ELSE 'toolB' END AS source", "CAST(pk % 3 AS STRING) AS target",
        "CAST(pk % 9 AS INT) AS p_start", "CAST(pk % 9 + 8 AS INT) AS p_end")


def intervals(spark: SparkSession, sf: str) -> DataFrame:
    """Overlapping intervals, several per order and sequence."""
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS id", "l_suppkey AS seqid", "l_partkey AS start",
        "l_partkey + CAST(l_quantity AS INT) AS end")


def tree_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Regions, nations, suppliers and customers as one feature tree."""
    def part(name: str, *columns: str) -> DataFrame:
        return table(spark, sf, name).selectExpr(*columns)

    rows = [
        part("region", "'R' || CAST(r_regionkey AS STRING) AS id", "CAST(NULL AS STRING) AS parent_id",
             "r_name AS name", "'gene' AS type", "r_regionkey AS start"),
        part("nation", "'N' || CAST(n_nationkey AS STRING) AS id", "'R' || CAST(n_regionkey AS STRING) AS parent_id",
             "n_name AS name", "'mRNA' AS type", "n_nationkey % 7 AS start"),
        part("supplier", "'S' || CAST(s_suppkey AS STRING) AS id", "'N' || CAST(s_nationkey AS STRING) AS parent_id",
             "s_name AS name", "'signal_peptide' AS type", "CAST(s_suppkey % 11 AS INT) AS start"),
        part("customer", "'C' || CAST(c_custkey AS STRING) AS id", "'N' || CAST(c_nationkey AS STRING) AS parent_id",
             "c_name AS name", "'match_part' AS type", "CAST(c_custkey % 13 AS INT) AS start"),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def tree_edges(spark: SparkSession, sf: str) -> DataFrame:
    return tree_nodes(spark, sf).filter("parent_id IS NOT NULL").selectExpr("id AS child_id", "parent_id")


def shared_edges(spark: SparkSession, sf: str) -> DataFrame:
    """The tree, with some suppliers also below the one before them and some customers also below suppliers."""
    after = table(spark, sf, "supplier").filter("s_suppkey % 3 = 0 AND s_suppkey > 1").selectExpr(
        "concat('S', s_suppkey) AS child_id", "concat('S', s_suppkey - 1) AS parent_id")
    below = table(spark, sf, "customer").selectExpr("c_custkey", "c_custkey % 97 AS s_suppkey").join(
        table(spark, sf, "supplier").select("s_suppkey"), "s_suppkey").selectExpr(
        "concat('C', c_custkey) AS child_id", "concat('S', s_suppkey) AS parent_id")
    known = tree_nodes(spark, sf).select(F.col("id").alias("parent_id"))
    return tree_edges(spark, sf).unionByName(after.join(known, "parent_id", "left_semi").select("child_id", "parent_id")).unionByName(below)


# members of all six tracks at three depths
_NUMBER = "CAST(substr(id, 2) AS INT)"
TRACK_TYPE = (
    f"CASE WHEN id LIKE 'R%' THEN 'gene' WHEN id LIKE 'N%' THEN CASE WHEN {_NUMBER} % 6 = 1 THEN 'protein_match' ELSE 'mRNA' END "
    f"WHEN id LIKE 'S%' THEN CASE {_NUMBER} % 5 WHEN 0 THEN 'signal_peptide' WHEN 1 THEN 'transit_peptide' WHEN 2 THEN "
    "'transmembrane_polypeptide_region' WHEN 3 THEN 'propeptide_cleavage_site' ELSE 'CDS' END "
    f"ELSE CASE {_NUMBER} % 4 WHEN 0 THEN 'match_part' WHEN 1 THEN 'polypeptide_motif' WHEN 2 THEN 'c_terminal_region' ELSE 'exon' END END")
TRACK = (
    f"CASE {TRACK_TYPE} WHEN 'protein_match' THEN 'protein_match' WHEN 'match_part' THEN 'protein_match' WHEN 'signal_peptide' THEN "
    "'signal_peptide' WHEN 'c_terminal_region' THEN 'signal_peptide' WHEN 'transit_peptide' THEN 'peptide_localization_signal' "
    "WHEN 'transmembrane_polypeptide_region' THEN 'transmembrane_polypeptide_region' WHEN 'propeptide_cleavage_site' THEN "
    "'propeptide_cleavage_site' WHEN 'polypeptide_motif' THEN 'polypeptide_motif' END")


# -- the check side ---------------------------------------------------------------
EVENTS_SQL = (
    "ev AS (SELECT event_id AS e, user_id AS u, value AS v, "
    "CAST(json_extract(props, '$.k') AS INT) AS k, event_type, ts FROM events)"
)
RESULTS_SQL = (
    f"{EVENTS_SQL}, res0 AS (SELECT *, " + ", ".join(f"{x} AS {c}" for c, x in ENVELOPE.items())
    + f" FROM ev), res AS (SELECT *, {SOFTWARE} AS software, {DATABASE} AS database, "
    f"{DATABASE_VERSION} AS database_version FROM res0)"
)
DECODER_SQL = (
    "decoder AS (SELECT 'S' || CAST(c_custkey AS STRING) AS checksum, 'M' || CAST(c_custkey AS STRING) AS md5sum, "
    "c_mktsegment AS filename, c_name AS name FROM customer)"
)
WIDE_DECODER_SQL = (
    "decoder AS (SELECT 'S' || CAST(o_custkey AS STRING) AS checksum, 'M' || CAST(o_custkey AS STRING) AS md5sum, "
    "CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS filename, "
    "'O' || CAST(o_orderkey AS STRING) AS name FROM orders)"
)
EXONS_SQL = (
    "ex AS (SELECT l_orderkey AS id, 'chr' || CAST(l_orderkey % 5 AS STRING) AS seqid, "
    "CASE WHEN l_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand, l_linenumber * 1000 AS s, "
    "l_linenumber * 1000 + CAST(max(l_quantity) AS INT) AS e FROM lineitem GROUP BY l_orderkey, l_linenumber)"
)
OFFSETS_SQL = (
    "off AS (SELECT *, COALESCE(SUM(e - s) OVER (PARTITION BY id ORDER BY CASE WHEN strand = '+' THEN s ELSE -s END "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c0 FROM ex)"
)
TREE_SQL = (
    "nodes AS (SELECT 'R' || CAST(r_regionkey AS STRING) AS id, CAST(NULL AS STRING) AS parent_id, r_name AS name, "
    "'gene' AS type, r_regionkey AS start FROM region UNION ALL SELECT 'N' || CAST(n_nationkey AS STRING), "
    "'R' || CAST(n_regionkey AS STRING), n_name, 'mRNA', n_nationkey % 7 FROM nation UNION ALL "
    "SELECT 'S' || CAST(s_suppkey AS STRING), 'N' || CAST(s_nationkey AS STRING), s_name, 'signal_peptide', "
    "CAST(s_suppkey % 11 AS INT) FROM supplier UNION ALL SELECT 'C' || CAST(c_custkey AS STRING), "
    "'N' || CAST(c_nationkey AS STRING), c_name, 'match_part', CAST(c_custkey % 13 AS INT) FROM customer)"
)

SHARED_EDGES_SQL = (
    "edges AS (SELECT id AS child_id, parent_id FROM nodes WHERE parent_id IS NOT NULL UNION ALL SELECT 'S' || CAST(s_suppkey AS STRING), "
    "'S' || CAST(s_suppkey - 1 AS STRING) FROM supplier WHERE s_suppkey % 3 = 0 AND s_suppkey > 1 AND s_suppkey - 1 IN (SELECT s_suppkey FROM supplier) UNION ALL "
    "SELECT 'C' || CAST(c_custkey AS STRING), 'S' || CAST(s_suppkey AS STRING) FROM customer JOIN supplier ON s_suppkey = c_custkey % 97)"
)


def payload_sql(analysis: str, field: str) -> str:
    """A payload field as a check expression, cast to the declared type."""
    types = {f.name: f.dataType.simpleString() for f in ANALYSES[analysis].schema.fields}
    return f"CAST({PAYLOADS[analysis][field]} AS {types[field]})"
