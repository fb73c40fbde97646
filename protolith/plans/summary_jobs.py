"""Aggregates, the wide summary, flags, scores and ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..analyses import ANALYSES
from ..functions.significance import alignment_significant, domain_significant
from ..functions.text import source_tag
from ..functions.topology import membrane_flag, signal_flag
from ..operators import scoring, summary
from . import bindings as B
from .bindings import payload_sql as p
from .registry import job

RES = f"WITH {B.RESULTS_SQL}"


def _rounded(df, *keep):
    """Doubles to six digits, so both engines print the same."""
    cols = keep or df.columns
    types = dict(df.dtypes)
    return df.select(*[F.round(c, 6).alias(c) if types[c] == "double" else F.col(c) for c in cols])


# -- check SQL, column by column ---------------------------------------------------
def _filtered(expr: str, kind: str) -> str:
    return f"MAX({expr}) FILTER (WHERE analysis = '{kind}')"


def _clamped(expr: str) -> str:
    return f"CASE WHEN {expr} IS NULL THEN NULL WHEN {expr} > 1 THEN 1.0 WHEN {expr} < 0 THEN 0.0 ELSE {expr} END"


def _numeric_sql() -> dict[str, str]:
    out = {}
    for name, kind, field, type_ in summary.MAX_COLUMNS:
        value = p(kind, field) if type_ != "flag" else f"CAST({p(kind, field)} AS INT)"
        out[name] = f"ROUND({_filtered(value, kind)}, 6)" if type_ == "double" else _filtered(value, kind)
    for name, kind, field in summary.PROB_COLUMNS:
        out[name] = f"ROUND({_clamped(_filtered(p(kind, field), kind))}, 6)"
    for name, kind, wanted in summary.PREDICTION_COLUMNS:
        out[name] = _filtered(f"CAST({p(kind, 'prediction')} = '{wanted}' AS INT)", kind)
    for name, wanted in summary.DEEPSIG_PROBS:
        best = f"MAX({p('deepsig', 'prob')}) FILTER (WHERE analysis = 'deepsig' AND {p('deepsig', 'prediction')} = '{wanted}')"
        out[name] = f"ROUND({_clamped(best)}, 6)"
    for name, kind, positives in summary.SIGNED_COLUMNS:
        listed = ", ".join(f"'{x}'" for x in positives)
        signed = f"CASE WHEN {p(kind, 'prediction')} IN ({listed}) THEN {p(kind, 'prob')} ELSE 1 - {p(kind, 'prob')} END"
        out[name] = f"ROUND({_filtered(signed, kind)}, 6)"
    hit = f"analysis = 'phibase' AND {p('phibase', 'evalue')} <= 1e-5 AND {p('phibase', 'tcov')} >= 0.5"
    parts = f"string_split(lower(split_part({p('phibase', 'target')}, '#', 6)), '__')"
    for name, wanted in (("effector", summary.EFFECTOR_PHENOTYPES), ("virulence", summary.VIRULENCE_PHENOTYPES),
                         ("lethal", summary.LETHAL_PHENOTYPES)):
        listed = ", ".join(f"'{x}'" for x in wanted)
        out[f"has_phibase_{name}_match"] = (
            f"COALESCE(MAX(CAST(list_has_any({parts}, [{listed}]) AS INT)) FILTER (WHERE {hit}), 0)")
    members = ", ".join(f"'{x}'" for x in summary.VIRULENCE_DOMAINS)
    out["has_dbcan_virulence_match"] = (
        f"COALESCE(MAX(CAST({p('dbcan', 'hmm')} IN ({members}) AS INT)) FILTER (WHERE analysis = 'dbcan'), 0)")

    def residues(letters):
        return " + ".join(_filtered(p("pepstats", f"residue_{r}_number"), "pepstats") for r in letters)
    out["fykin_gap"] = f"ROUND((1.0 * ({residues('fkyin')}) + 1) / (1.0 * ({residues('gap')}) + 1), 6)"
    return out


NUMERIC = _numeric_sql()


def _numeric_check(*names: str) -> str:
    cols = ", ".join(f"{NUMERIC[n]} AS {n}" for n in names)
    return f"{RES} SELECT checksum, {cols} FROM res GROUP BY checksum"


def _numeric_job(name: str, *columns: str) -> None:
    @job(name, _numeric_check(*columns))
    def run(spark, sf):
        return _rounded(summary.numeric_summary(B.results(spark, sf)), "checksum", *columns)


_numeric_job("agg_max_field", *[c for c, *_ in summary.MAX_COLUMNS])
_numeric_job("agg_max_prob", *[c for c, *_ in summary.PROB_COLUMNS])
_numeric_job("agg_any_equal", *[c for c, *_ in summary.PREDICTION_COLUMNS])
_numeric_job("agg_prob_of_pred", *[c for c, _ in summary.DEEPSIG_PROBS])
_numeric_job("agg_signed_prob", *[c for c, *_ in summary.SIGNED_COLUMNS])
_numeric_job("agg_member_flag", "has_dbcan_virulence_match")
_numeric_job("agg_multi_any", "has_phibase_effector_match", "has_phibase_virulence_match", "has_phibase_lethal_match")
_numeric_job("agg_ratio", "fykin_gap")


# -- list columns -------------------------------------------------------------------
def _domain_hits(kind: str) -> str:
    cov = f"({p(kind, 'hmm_to')} - {p(kind, 'hmm_from')}) / CAST({p(kind, 'hmm_len')} AS DOUBLE)"
    span = f"{p(kind, 'query_to')} - {p(kind, 'query_from')}"
    ev = p(kind, "domain_i_evalue")
    return (f"CASE WHEN {cov} < 0.3 THEN FALSE WHEN {span} > 80 THEN {ev} < 1e-5 ELSE {ev} < 1e-3 END")


def _evidence_cte(out: str, kind: str) -> str:
    return (
        f"{out}0 AS (SELECT checksum, {p(kind, 'hmm')} AS key, MIN({p(kind, 'domain_i_evalue')}) AS m FROM res "
        f"WHERE analysis = '{kind}' AND {_domain_hits(kind)} GROUP BY 1, 2), "
        f"{out} AS (SELECT checksum, string_agg(key, ',' ORDER BY m, key) AS {out} FROM {out}0 GROUP BY 1)")


def _homology_cte(out: str, part: int) -> str:
    return (
        f"{out}0 AS (SELECT checksum, {p('phibase', 'evalue')} AS m, "
        f"unnest(list_distinct(string_split(split_part({p('phibase', 'target')}, '#', {part + 1}), '__'))) AS key "
        f"FROM res WHERE analysis = 'phibase' AND {p('phibase', 'evalue')} <= 1e-5 AND {p('phibase', 'tcov')} >= 0.5), "
        f"{out}1 AS (SELECT checksum, key, MIN(m) AS m FROM {out}0 GROUP BY 1, 2), "
        f"{out} AS (SELECT checksum, string_agg(key, ',' ORDER BY m, key) AS {out} FROM {out}1 GROUP BY 1)")


_KEX = {f: p("kex2_cutsite", f) for f in ("pattern", "match", "start", "end")}
_RXLR = {f: p("rxlr_like_motif", f) for f in ("match", "start", "end")}
KEX_CTE = (
    f"kex0 AS (SELECT DISTINCT checksum, replace({_KEX['pattern']}, '[A-Z]', 'X') AS pat, {_KEX['match']} AS m, "
    f"{_KEX['start']} AS s, {_KEX['end']} AS e2 FROM res WHERE analysis = 'kex2_cutsite'), "
    "kex1 AS (SELECT checksum, m, s, e2, string_agg(pat, '&' ORDER BY pat) AS pats FROM kex0 GROUP BY 1, 2, 3, 4), "
    "kex2_cutsites AS (SELECT checksum, string_agg(m || ':' || pats || ':' || CAST(s + 1 AS STRING) || '-' || "
    "CAST(e2 AS STRING), ',' ORDER BY s, m) AS kex2_cutsites FROM kex1 GROUP BY 1)")
RXLR_CTE = (
    f"rx0 AS (SELECT DISTINCT checksum, software_version, pipeline_version, name, {_RXLR['match']} AS m, "
    f"{_RXLR['start']} AS s, {_RXLR['end']} AS e2 FROM res WHERE analysis = 'rxlr_like_motif'), "
    "rxlr_like_motifs AS (SELECT checksum, string_agg(m || ':' || CAST(s + 1 AS STRING) || '-' || CAST(e2 AS STRING), "
    "',' ORDER BY s, m) AS rxlr_like_motifs FROM rx0 GROUP BY 1)")


def _signal_end_sql() -> str:
    cases = {
        "signalp3_nn": f"CASE WHEN {p('signalp3_nn', 'd_decision')} THEN {p('signalp3_nn', 'ymax_pos')} - 1 END",
        "signalp3_hmm": f"CASE WHEN {p('signalp3_hmm', 'is_secreted')} THEN {p('signalp3_hmm', 'cmax_pos')} - 1 END",
        "signalp4": f"CASE WHEN {p('signalp4', 'decision')} THEN {p('signalp4', 'ymax_pos')} - 1 END",
        "signalp5": "CASE WHEN k >= 50 THEN k END", "signalp6": "CASE WHEN k >= 50 THEN k END",
        "deepsig": "CASE WHEN k % 3 = 0 THEN k + 1 END", "phobius": "CASE WHEN k % 2 = 0 THEN k + 15 END",
    }
    return "CASE analysis " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in cases.items()) + " END"


_LABEL = "CASE analysis " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in summary.CUT_SITE_LABELS.items()) + " END"
_SIGNAL_KINDS = ", ".join(f"'{k}'" for k in summary.SIGNAL_ANALYSES)
# payloads of these kinds depend on k and v only
SIGNAL_CTE = (
    "sig0 AS (SELECT DISTINCT analysis, checksum, software_version, pipeline_version, k, "
    "CASE WHEN analysis IN ('signalp4', 'signalp5', 'tmhmm') THEN v END AS v1 "
    f"FROM res WHERE analysis IN ({_SIGNAL_KINDS})), "
    f"sig1 AS (SELECT *, {_signal_end_sql()} AS sp_end, {_LABEL} AS label, "
    "CASE WHEN analysis = 'phobius' THEN k + 29 WHEN analysis = 'tmhmm' AND k % 3 > 0 THEN k + 4 END AS ts, "
    "CASE WHEN analysis = 'phobius' THEN k + 50 WHEN analysis = 'tmhmm' AND k % 3 > 0 THEN k + 25 END AS te FROM sig0), "
    "cuts AS (SELECT checksum, string_agg(label || ':' || CAST(sp_end AS STRING), ',' ORDER BY sp_end, label) AS "
    "signal_peptide_cutsites FROM sig1 WHERE sp_end > 0 GROUP BY 1)")


def _segment_cte(out: str, kind: str) -> str:
    return (f"{out} AS (SELECT checksum, 'tm:' || string_agg(CAST(ts + 1 AS STRING) || '-' || CAST(te AS STRING), ',' "
            f"ORDER BY ts) AS {out} FROM sig1 WHERE analysis = '{kind}' AND ts IS NOT NULL GROUP BY 1)")


SEGMENT_CTE = _segment_cte("phobius_tm_domains", "phobius") + ", " + _segment_cte("tmhmm_domains", "tmhmm")
OVERLAP_CTE = (
    "tm1 AS (SELECT checksum, min(struct_pack(s := ts, e := te)) AS t FROM sig1 WHERE ts IS NOT NULL GROUP BY 1), "
    "ov AS (SELECT s.checksum, median(greatest(least(sp_end, t.e) - greatest(t.s, 0), 0) / CAST(t.e - t.s AS DOUBLE)) AS m "
    "FROM sig1 s JOIN tm1 USING (checksum) WHERE sp_end > 0 GROUP BY 1), "
    "overlap AS (SELECT c.checksum, ROUND(COALESCE(m, 0.0), 6) AS tmhmm_first_tm_sp_coverage "
    "FROM (SELECT DISTINCT checksum FROM sig0) c LEFT JOIN ov USING (checksum))")
EVIDENCE = (("effector_matches", "effectordb"), ("dbcan_matches", "dbcan"))
HOMOLOGY = (("phibase_ids", 1), ("phibase_genes", 2), ("phibase_phenotypes", 5))
LIST_CTES = ", ".join(
    [_evidence_cte(o, k) for o, k in EVIDENCE] + [_homology_cte(o, i) for o, i in HOMOLOGY] + [KEX_CTE, RXLR_CTE])


def _full(names: list[str], ctes: str, tables: list[str]) -> str:
    joined = tables[0] + "".join(f" FULL JOIN {t} USING (checksum)" for t in tables[1:])
    return f"{RES}, {ctes} SELECT checksum, {', '.join(names)} FROM {joined}"


@job("agg_evidence_list", _full(
    [o for o, _ in EVIDENCE], ", ".join(_evidence_cte(o, k) for o, k in EVIDENCE), [o for o, _ in EVIDENCE]))
def agg_evidence_list(spark, sf):
    lists = summary.list_summary(B.results(spark, sf).filter(F.col("analysis").isin("effectordb", "dbcan")))
    return lists.select("checksum", "effector_matches", "dbcan_matches").filter(
        "effector_matches IS NOT NULL OR dbcan_matches IS NOT NULL")


@job("agg_multi_evidence", _full(
    [o for o, _ in HOMOLOGY], ", ".join(_homology_cte(o, i) for o, i in HOMOLOGY), [o for o, _ in HOMOLOGY]))
def agg_multi_evidence(spark, sf):
    lists = summary.list_summary(B.results(spark, sf).filter(F.col("analysis") == "phibase"))
    return lists.select("checksum", "phibase_ids", "phibase_genes", "phibase_phenotypes")


@job("agg_motif_groups", f"{RES}, {KEX_CTE} SELECT * FROM kex2_cutsites")
def agg_motif_groups(spark, sf):
    return summary.list_summary(B.results(spark, sf).filter(F.col("analysis") == "kex2_cutsite")).select(
        "checksum", "kex2_cutsites")


def _distinct(spark, sf):
    from ..operators.store import distinct_results
    return distinct_results(B.results(spark, sf))


@job("agg_motif_list", f"{RES}, {RXLR_CTE} SELECT * FROM rxlr_like_motifs")
def agg_motif_list(spark, sf):
    return summary.list_summary(_distinct(spark, sf).filter(F.col("analysis") == "rxlr_like_motif")).select(
        "checksum", "rxlr_like_motifs")


@job("agg_cutsites", f"{RES}, {SIGNAL_CTE} SELECT * FROM cuts")
def agg_cutsites(spark, sf):
    return summary.signal_summary(_distinct(spark, sf)).select(
        "checksum", "signal_peptide_cutsites").filter("signal_peptide_cutsites IS NOT NULL")


@job("agg_segments", _full(["phobius_tm_domains", "tmhmm_domains"], f"{SIGNAL_CTE}, {SEGMENT_CTE}",
                           ["phobius_tm_domains", "tmhmm_domains"]))
def agg_segments(spark, sf):
    return summary.signal_summary(_distinct(spark, sf)).select(
        "checksum", "phobius_tm_domains", "tmhmm_domains").filter(
        "phobius_tm_domains IS NOT NULL OR tmhmm_domains IS NOT NULL")


@job("agg_median_overlap", f"{RES}, {SIGNAL_CTE}, {OVERLAP_CTE} SELECT * FROM overlap")
def agg_median_overlap(spark, sf):
    return _rounded(summary.signal_summary(_distinct(spark, sf)), "checksum", "tmhmm_first_tm_sp_coverage")


# -- the wide summary and what follows from it ---------------------------------------
WIDE_COLUMNS = [c for c in NUMERIC] + [o for o, _ in EVIDENCE] + [o for o, _ in HOMOLOGY] + [
    "kex2_cutsites", "rxlr_like_motifs", "signal_peptide_cutsites", "phobius_tm_domains", "tmhmm_domains",
    "tmhmm_first_tm_sp_coverage"]
_WIDE_TABLES = [o for o, _ in EVIDENCE] + [o for o, _ in HOMOLOGY] + [
    "kex2_cutsites", "rxlr_like_motifs", "cuts", "phobius_tm_domains", "tmhmm_domains", "overlap"]
WIDE_SQL = (
    f"{RES}, {B.DECODER_SQL}, num AS (SELECT checksum, "
    + ", ".join(f"{x} AS {n}" for n, x in NUMERIC.items()) + f" FROM res GROUP BY checksum), {LIST_CTES}, "
    f"{SIGNAL_CTE}, {SEGMENT_CTE}, {OVERLAP_CTE}, names AS (SELECT DISTINCT checksum, name FROM decoder), "
    f"wide AS (SELECT checksum, name, {', '.join(WIDE_COLUMNS)} FROM num "
    + " ".join(f"LEFT JOIN {t} USING (checksum)" for t in _WIDE_TABLES) + " JOIN names USING (checksum))"
)
_ANY = "greatest(" + ", ".join(f"COALESCE({c}, 0)" for c in scoring.SIGNAL_COLUMNS) + ") > 0"
_MULTI = "(COALESCE(tmhmm_tmcount > 1, FALSE) OR COALESCE(phobius_tmcount > 1, FALSE))"
FLAG_SQL = (
    f"flags AS (SELECT *, CAST({_ANY} AS INT) AS any_signal_peptide, CAST({_MULTI} AS INT) AS multiple_transmembrane, "
    f"CAST(NOT {_MULTI} AND COALESCE(phobius_tmcount = 1, FALSE) AS INT) AS single_transmembrane, "
    f"CAST({_ANY} AND NOT {_MULTI} AS INT) AS is_secreted FROM wide)")


def _z(c: str, d: str = "0") -> str:
    return f"COALESCE(CAST({c} AS DOUBLE), {d})"


_SECRETION = (
    f"3 * {_z('is_secreted')} + 0.25 * (" + " + ".join(_z(c) for c in scoring.OK_SIGNALS) + ") + 0.5 * ("
    + " + ".join(_z(c) for c in scoring.GOOD_SIGNALS) + f") - 6 * {_z('multiple_transmembrane')} "
    f"- 2 * {_z('single_transmembrane')} + {_z('deeploc_extracellular')} - 0.5 * ("
    + " + ".join(_z(c) for c in scoring.INTRACELLULAR) + f") - {_z('deeploc_membrane')} "
    f"- 0.5 * {_z('targetp_mitochondrial_prob')}")
_HOMOLOG = (
    "CASE WHEN has_phibase_effector_match <> 0 OR effector_matches IS NOT NULL OR has_dbcan_virulence_match <> 0 "
    "THEN 1 ELSE 0 END")
_EFFECTOR = (
    f"secretion + 6 * ({_z('effectorp1', '0.5')} - 0.5) + 6 * ({_z('effectorp2', '0.5')} - 0.5) "
    f"+ 3 * {_z('effectorp3_apoplastic')} + 3 * {_z('effectorp3_cytoplasmic')} - 3 * {_z('effectorp3_noneffector')} "
    f"+ 4 * ({_z('deepredeff_fungi', '0.5')} - 0.5) + 4 * ({_z('deepredeff_oomycete', '0.5')} - 0.5) "
    f"+ 5 * ({_HOMOLOG}) + (-1 - ({_HOMOLOG})) * {_z('has_phibase_virulence_match')} "
    f"- 5 * {_z('has_phibase_lethal_match')}")
SCORE_SQL = (
    f"sec AS (SELECT *, {_SECRETION} AS secretion FROM flags), "
    f"scored AS (SELECT *, {_EFFECTOR} AS effector FROM sec)")


def _wide(spark, sf):
    return summary.wide_summary(B.results(spark, sf), B.decoder(spark, sf))


def _scored(spark, sf):
    # rounded first: the check's inputs are rounded too
    wide = _rounded(_wide(spark, sf))
    return scoring.with_scores(scoring.score_flags(wide))


@job("wide_summary", f"{WIDE_SQL} SELECT * FROM wide")
def wide_summary(spark, sf):
    return _rounded(_wide(spark, sf), "checksum", "name", *WIDE_COLUMNS)


@job("score_flags", f"{WIDE_SQL}, {FLAG_SQL} SELECT name, any_signal_peptide, multiple_transmembrane, "
     "single_transmembrane, is_secreted FROM flags")
def score_flags(spark, sf):
    return scoring.score_flags(_wide(spark, sf)).select(
        "name", "any_signal_peptide", "multiple_transmembrane", "single_transmembrane", "is_secreted")


@job("score_secretion", f"{WIDE_SQL}, {FLAG_SQL}, {SCORE_SQL} SELECT name, ROUND(secretion, 4) AS score FROM scored")
def score_secretion(spark, sf):
    return _scored(spark, sf).select("name", F.round("manual_secretion_score", 4).alias("score"))


@job("score_effector", f"{WIDE_SQL}, {FLAG_SQL}, {SCORE_SQL} SELECT name, ROUND(effector, 4) AS score FROM scored")
def score_effector(spark, sf):
    return _scored(spark, sf).select("name", F.round("manual_effector_score", 4).alias("score"))


@job("rank_order", f"{WIDE_SQL}, {FLAG_SQL}, {SCORE_SQL} SELECT name, ROUND(effector, 3) AS effector_score, "
     "is_secreted FROM scored ORDER BY 2 DESC NULLS LAST, 1")
def rank_order(spark, sf):
    scored = _scored(spark, sf).select(
        "name", F.col("manual_effector_score").alias("effector_score"), "is_secreted")
    return scoring.rank(scored)


_PROPS = {f"aa_{x}_prop": f"aa_{x}_number / CAST(residue_number AS DOUBLE)" for x in scoring.PROPORTIONS}


@job("ltr_features", f"{WIDE_SQL} SELECT name, " + ", ".join(
    f"ROUND({_PROPS.get(c, c)}, 5) AS {c}" if t == "double" else f"{c}" for c, t in scoring.MODEL_INPUTS) + " FROM wide")
def ltr_features(spark, sf):
    out = scoring.model_features(_rounded(_wide(spark, sf)))
    types = dict(out.dtypes)
    return out.select(*[F.round(c, 5).alias(c) if types[c] == "double" else F.col(c) for c in out.columns])


@job("model_score", f"{WIDE_SQL} SELECT name, ROUND((COALESCE(effectorp1, 0.5) + COALESCE(effectorp2, 0.5)) / 2, 8) "
     "AS effector_score FROM wide")
def model_score(spark, sf):
    """A stand-in model; the published one is not shipped."""
    def model(inputs):
        return (inputs["effectorp1"].fillna(0.5) + inputs["effectorp2"].fillna(0.5)) / 2

    out = scoring.score_with_model(_rounded(_wide(spark, sf)), model)
    return out.withColumn("effector_score", F.round("effector_score", 8))


# -- per-row checks -------------------------------------------------------------------
def _typed(spark, sf, kind):
    rows = B.results(spark, sf).filter(F.col("analysis") == kind)
    return rows.select("e", F.from_json("data", ANALYSES[kind].schema).alias("d")).select("e", "d.*")


def _domain_rows(spark, sf, kind):
    d = _typed(spark, sf, kind)
    hit = domain_significant(
        F.col("hmm_from"), F.col("hmm_to"), F.col("hmm_len"), F.col("query_from"), F.col("query_to"),
        F.col("domain_i_evalue"))
    return d.select("e", hit.alias("significant"))


@job("sig_hmm", f"{RES} SELECT e, {_domain_hits('dbcan')} AS significant FROM res WHERE analysis = 'dbcan' UNION ALL "
     f"SELECT e, {_domain_hits('effectordb')} FROM res WHERE analysis = 'effectordb'")
def sig_hmm(spark, sf):
    return _domain_rows(spark, sf, "dbcan").unionByName(_domain_rows(spark, sf, "effectordb"))


@job("sig_aln", f"{RES} SELECT e, ({p('phibase', 'evalue')} <= 1e-5 AND {p('phibase', 'tcov')} >= 0.5) AS significant "
     "FROM res WHERE analysis = 'phibase'")
def sig_aln(spark, sf):
    return _typed(spark, sf, "phibase").select(
        "e", alignment_significant(F.col("evalue"), F.col("tcov")).alias("significant"))


@job("sig_flag", f"{RES} SELECT e, {p('pfamscan', 'is_significant')} AS significant FROM res WHERE analysis = 'pfamscan'")
def sig_flag(spark, sf):
    return _typed(spark, sf, "pfamscan").select("e", F.col("is_significant").alias("significant"))


@job("feature_source", f"{RES} SELECT e, concat_ws(':', software, software_version, database, database_version) AS source "
     "FROM res")
def feature_source(spark, sf):
    r = B.plain_results(spark, sf)
    return r.select("e", source_tag(
        F.col("software"), F.col("software_version"), F.col("database"), F.col("database_version")).alias("source"))


# labels made from whole documents: twenty letters run together as one label
_LABELS = ("abcdefghijklmnopqrstuvwxyz", "HHHHHHHHHHHHHHHHHHSSSSSSbb")
_LABEL_SQL = (
    "lab AS (SELECT doc_id, translate(lower(regexp_replace(text, '[^A-Za-z]', '', 'g')), "
    f"'{_LABELS[0]}', '{_LABELS[1]}') AS s FROM documents)")


@job("topology_flags", f"WITH {_LABEL_SQL} SELECT doc_id, length(regexp_replace(lower(substr(s, 1, 30)), '[^s]', '', 'g')) "
     "> 10 AS has_sp, COALESCE(list_max(list_transform(regexp_extract_all(s, 'B+|b+|H+|h+'), lambda x: length(x))), 0) > 10 "
     "AS has_tm FROM lab")
def topology_flags(spark, sf):
    text = F.regexp_replace("text", "[^A-Za-z]", "")
    labels = B.table(spark, sf, "documents").select(
        "doc_id", F.translate(F.lower(text), _LABELS[0], _LABELS[1]).alias("s"))
    return labels.select("doc_id", signal_flag(F.col("s")).alias("has_sp"),
                         membrane_flag(F.col("s")).alias("has_tm"))


def _signed_sql(out: str, kind: str, positives: tuple[str, ...]) -> str:
    yes = ", ".join(f"'{x}'" for x in positives)
    signed = f"CASE WHEN {p(kind, 'prediction')} IN ({yes}) THEN {p(kind, 'prob')} ELSE 1 - {p(kind, 'prob')} END"
    return f"SELECT checksum, '{out}' AS \"column\" FROM res WHERE analysis = '{kind}' GROUP BY checksum HAVING min({signed}) <> max({signed})"


@job("prediction_conflicts", f"{RES} " + " UNION ALL ".join(_signed_sql(*x) for x in summary.SIGNED_COLUMNS))
def prediction_conflicts(spark, sf):
    """Sequences whose rows disagree about a signed probability."""
    return summary.prediction_conflicts(B.results(spark, sf))
