"""One wide row per sequence: the flagship aggregation.

Every summary column depends on the checksum only, so results are folded per
checksum first and the names are joined to the folded rows.  The payload is
parsed once per row.  List-valued columns run beside the main aggregate: items
are reduced to distinct keys per sequence before any list is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import aggregates as A
from ..functions.significance import alignment_significant, domain_significant
from ..functions.text import cut_position
from ..functions.topology import membrane_segments, signal_regions
from .scoring import score_flags

# --- fixed values: summary columns that are a plain maximum -------------------
# (column, analysis, payload field, type)
MAX_COLUMNS = (
    ("effectorp3_cytoplasmic", "effectorp3", "cytoplasmic_prob", "double"),
    ("effectorp3_apoplastic", "effectorp3", "apoplastic_prob", "double"),
    ("effectorp3_noneffector", "effectorp3", "noneffector_prob", "double"),
    ("deepredeff_fungi", "deepredeff_fungi", "s_score", "double"),
    ("deepredeff_oomycete", "deepredeff_oomycete", "s_score", "double"),
    ("molecular_weight", "pepstats", "molecular_weight", "double"),
    ("residue_number", "pepstats", "residues", "int"),
    ("charge", "pepstats", "charge", "double"),
    ("isoelectric_point", "pepstats", "isoelectric_point", "double"),
    ("aa_c_number", "pepstats", "residue_c_number", "int"),
    ("aa_tiny_number", "pepstats", "property_tiny_number", "int"),
    ("aa_small_number", "pepstats", "property_small_number", "int"),
    ("aa_aliphatic_number", "pepstats", "property_aliphatic_number", "int"),
    ("aa_aromatic_number", "pepstats", "property_aromatic_number", "int"),
    ("aa_nonpolar_number", "pepstats", "property_nonpolar_number", "int"),
    ("aa_charged_number", "pepstats", "property_charged_number", "int"),
    ("aa_basic_number", "pepstats", "property_basic_number", "int"),
    ("aa_acidic_number", "pepstats", "property_acidic_number", "int"),
    ("localizer_nucleus", "localizer", "nucleus_decision", "flag"),
    ("localizer_chloro", "localizer", "chloroplast_decision", "flag"),
    ("localizer_mito", "localizer", "mitochondria_decision", "flag"),
    ("signalp3_nn", "signalp3_nn", "d_decision", "flag"),
    ("signalp3_hmm", "signalp3_hmm", "is_secreted", "flag"),
    ("signalp4", "signalp4", "decision", "flag"),
    ("phobius_sp", "phobius", "sp", "flag"),
    ("phobius_tmcount", "phobius", "tm", "int"),
    ("tmhmm_tmcount", "tmhmm", "pred_hel", "int"),
    ("tmhmm_first_60", "tmhmm", "first_60", "double"),
    ("tmhmm_exp_aa", "tmhmm", "exp_aa", "double"),
    ("signalp3_nn_d", "signalp3_nn", "d", "double"),
    ("signalp3_hmm_s", "signalp3_hmm", "sprob", "double"),
    ("signalp4_d", "signalp4", "d", "double"),
)
# maxima clamped to [0, 1]: (column, analysis, payload field)
PROB_COLUMNS = (
    ("targetp_secreted_prob", "targetp_non_plant", "sp"),
    ("targetp_mitochondrial_prob", "targetp_non_plant", "mtp"),
    ("deeploc_membrane", "deeploc", "membrane"),
    ("deeploc_nucleus", "deeploc", "nucleus"),
    ("deeploc_cytoplasm", "deeploc", "cytoplasm"),
    ("deeploc_extracellular", "deeploc", "extracellular"),
    ("deeploc_mitochondrion", "deeploc", "mitochondrion"),
    ("deeploc_cell_membrane", "deeploc", "cell_membrane"),
    ("deeploc_endoplasmic_reticulum", "deeploc", "endoplasmic_reticulum"),
    ("deeploc_plastid", "deeploc", "plastid"),
    ("deeploc_golgi", "deeploc", "golgi_apparatus"),
    ("deeploc_lysosome", "deeploc", "lysosome_vacuole"),
    ("deeploc_peroxisome", "deeploc", "peroxisome"),
    ("signalp5_prob", "signalp5", "prob_signal"),
    ("signalp6_prob", "signalp6", "prob_signal"),
)
# (column, analysis, prediction that counts)
PREDICTION_COLUMNS = (
    ("signalp5", "signalp5", "SP(Sec/SPI)"),
    ("signalp6", "signalp6", "SP"),
    ("deepsig", "deepsig", "SignalPeptide"),
    ("targetp_secreted", "targetp_non_plant", "SP"),
)
# (column, prediction whose probability is wanted)
DEEPSIG_PROBS = (
    ("deepsig_signal_prob", "SignalPeptide"),
    ("deepsig_transmembrane_prob", "Transmembrane"),
    ("deepsig_other_prob", "Other"),
)
# (column, analysis, positive predictions)
SIGNED_COLUMNS = (
    ("effectorp1", "effectorp1", ("Effector",)),
    ("effectorp2", "effectorp2", ("Effector", "Unlikely effector")),
    ("apoplastp", "apoplastp", ("Apoplastic",)),
)
EFFECTOR_PHENOTYPES = (
    "loss_of_pathogenicity",
    "increased_virulence_(hypervirulence)",
    "effector_(plant_avirulence_determinant)",
)
VIRULENCE_PHENOTYPES = ("reduced_virulence",)
LETHAL_PHENOTYPES = ("lethal",)
VIRULENCE_DOMAINS = ("CBM50", "AA9", "GH10", "GH11")
# labels of the tools in the cut-site list
CUT_SITE_LABELS = {
    "signalp3_hmm": "SignalP3HMM", "signalp3_nn": "SignalP3NN", "signalp4": "SignalP4",
    "signalp5": "SignalP5", "signalp6": "SignalP6", "deepsig": "DeepSig", "phobius": "Phobius",
}
SUMMARY_ORDER = (
    "name", "effector_score", "manual_effector_score", "manual_secretion_score",
    "effector_matches", "phibase_genes", "phibase_phenotypes", "phibase_ids",
    "has_phibase_effector_match", "has_phibase_virulence_match", "has_phibase_lethal_match",
    "dbcan_matches", "has_dbcan_virulence_match", "effectorp1", "effectorp2",
    "effectorp3_cytoplasmic", "effectorp3_apoplastic", "effectorp3_noneffector",
    "deepredeff_fungi", "deepredeff_oomycete", "apoplastp", "is_secreted",
    "any_signal_peptide", "single_transmembrane", "multiple_transmembrane",
    "molecular_weight", "residue_number", "charge", "isoelectric_point", "aa_c_number",
    "aa_tiny_number", "aa_small_number", "aa_aliphatic_number", "aa_aromatic_number",
    "aa_nonpolar_number", "aa_charged_number", "aa_basic_number", "aa_acidic_number",
    "fykin_gap", "kex2_cutsites", "rxlr_like_motifs", "localizer_nucleus",
    "localizer_chloro", "localizer_mito", "signal_peptide_cutsites", "signalp3_nn",
    "signalp3_hmm", "signalp4", "signalp5", "signalp6", "deepsig", "phobius_sp",
    "phobius_tmcount", "phobius_tm_domains", "tmhmm_tmcount", "tmhmm_first_60",
    "tmhmm_exp_aa", "tmhmm_first_tm_sp_coverage", "tmhmm_domains", "targetp_secreted",
    "targetp_secreted_prob", "targetp_mitochondrial_prob", "deeploc_membrane",
    "deeploc_nucleus", "deeploc_cytoplasm", "deeploc_extracellular",
    "deeploc_mitochondrion", "deeploc_cell_membrane", "deeploc_endoplasmic_reticulum",
    "deeploc_plastid", "deeploc_golgi", "deeploc_lysosome", "deeploc_peroxisome",
    "signalp3_nn_d", "signalp3_hmm_s", "signalp4_d", "signalp5_prob", "signalp6_prob",
    "deepsig_signal_prob", "deepsig_transmembrane_prob", "deepsig_other_prob",
)
# --- end of fixed values ------------------------------------------------------

NUMERATOR_RESIDUES = "fkyin"
DENOMINATOR_RESIDUES = "gap"
MAX_PAYLOAD = sorted({
    *[f for _, _, f, _ in MAX_COLUMNS], *[f for _, _, f in PROB_COLUMNS],
    *[f"residue_{r}_number" for r in NUMERATOR_RESIDUES + DENOMINATOR_RESIDUES],
    "prediction", "prob", "hmm", "evalue", "tcov", "target",
})
LIST_PAYLOAD = (
    "hmm", "hmm_len", "hmm_from", "hmm_to", "query_from", "query_to", "domain_i_evalue",
    "evalue", "tcov", "target", "pattern", "match", "start", "end",
)
SIGNAL_PAYLOAD = (
    "topology", "sp", "is_secreted", "cmax_pos", "d_decision", "ymax_pos", "decision",
    "cs_pos", "prediction",
)


def _parse(results: DataFrame, fields) -> DataFrame:
    """One JSON pass per row; fields stay text because kinds reuse names with other types."""
    schema = ", ".join(f"`{f}` string" for f in fields)
    return results.select("checksum", "analysis", F.from_json("data", schema).alias("p"))


def _field(name: str, kind: str = "string") -> Column:
    value = F.col("p")[name]
    if kind == "flag":
        return value.try_cast("boolean").cast("int")
    return value if kind == "string" else value.try_cast(kind)


def _is(analysis: str) -> Column:
    return F.col("analysis") == analysis


def domain_hit_counts() -> Column:
    return domain_significant(
        _field("hmm_from", "int"), _field("hmm_to", "int"), _field("hmm_len", "int"),
        _field("query_from", "int"), _field("query_to", "int"),
        _field("domain_i_evalue", "double"))


def phenotype_parts(target: Column, part: int) -> Column:
    """One ``#`` part of a homology target, split on double underscores."""
    return F.split(F.split(F.trim(target), "#")[part], "__")


def _signed(strict: bool) -> list[Column]:
    """Signed probabilities; with ``strict`` rows that disagree fail the job."""
    out = []
    for name, a, positives in SIGNED_COLUMNS:
        args = (_field("prob", "double"), _field("prediction"), list(positives), _is(a))
        value = A.signed_prob(*args)
        if strict:
            failed = F.raise_error(F.concat(F.lit(f"several values of {name}: "), F.first("checksum"))).cast("double")
            value = F.when(A.signed_prob_conflict(*args), failed).otherwise(value)
        out.append(value.alias(name))
    return out


def prediction_conflicts(results: DataFrame) -> DataFrame:
    """``checksum, column`` where the rows of a sequence disagree about a signed probability."""
    parsed = _parse(results.filter(F.col("analysis").isin(*{a for _, a, _ in SIGNED_COLUMNS})), ("prob", "prediction"))
    flags = [A.signed_prob_conflict(_field("prob", "double"), _field("prediction"), list(pos), _is(a)).alias(out) for out, a, pos in SIGNED_COLUMNS]
    names = F.filter(F.array(*[F.when(F.col(out), F.lit(out)) for out, _, _ in SIGNED_COLUMNS]), lambda c: c.isNotNull())
    return parsed.groupBy("checksum").agg(*flags).select("checksum", F.explode(names).alias("column"))


def numeric_summary(results: DataFrame, members: tuple[str, ...] = VIRULENCE_DOMAINS, strict: bool = False) -> DataFrame:
    """All single-valued columns, one hash aggregate per checksum."""
    rows = _parse(results, MAX_PAYLOAD)
    hit = _is("phibase") & alignment_significant(_field("evalue", "double"), _field("tcov", "double"))
    phenotypes = phenotype_parts(F.lower(_field("target")), 5)

    def has(wanted) -> Column:
        found = F.arrays_overlap(phenotypes, F.array(*[F.lit(w) for w in wanted]))
        return F.coalesce(A.max_field(found.cast("int"), hit), F.lit(0))

    def residues(letters: str) -> list[Column]:
        return [A.max_field(_field(f"residue_{r}_number", "int"), _is("pepstats")) for r in letters]

    columns = [A.max_field(_field(f, kind), _is(a)).alias(out) for out, a, f, kind in MAX_COLUMNS]
    columns += [A.max_prob(_field(f, "double"), _is(a)).alias(out) for out, a, f in PROB_COLUMNS]
    columns += [A.any_equal(_field("prediction"), v, _is(a)).alias(out) for out, a, v in PREDICTION_COLUMNS]
    columns += [
        A.prob_of_prediction(_field("prob", "double"), _field("prediction"), v, _is("deepsig")).alias(out)
        for out, v in DEEPSIG_PROBS]
    columns += _signed(strict)
    columns += [
        has(EFFECTOR_PHENOTYPES).alias("has_phibase_effector_match"),
        has(VIRULENCE_PHENOTYPES).alias("has_phibase_virulence_match"),
        has(LETHAL_PHENOTYPES).alias("has_phibase_lethal_match"),
        A.member_flag(_field("hmm"), list(members), _is("dbcan")).alias("has_dbcan_virulence_match"),
        A.ratio_of_sums(residues(NUMERATOR_RESIDUES), residues(DENOMINATOR_RESIDUES)).alias("fykin_gap"),
    ]
    return rows.groupBy("checksum").agg(*columns)


# -- list-valued columns -------------------------------------------------------
ITEM = "array<struct<list string, head string, tail string, metric double, pattern string>>"


def _item(name: str, head: Column, tail=None, metric=None, pattern=None) -> Column:
    def text(c):
        return F.lit(None).cast("string") if c is None else c
    rank = F.lit(None).cast("double") if metric is None else metric.cast("double")
    return F.struct(F.lit(name).alias("list"), head.alias("head"), text(tail).alias("tail"),
                    rank.alias("metric"), text(pattern).alias("pattern"))


def list_items(rows: DataFrame) -> DataFrame:
    """Every entry of every list column: ``checksum, list, head, tail, metric, pattern``."""
    start, end = _field("start", "int") + 1, _field("end", "int")
    span = F.concat_ws("-", start.cast("string"), end.cast("string"))
    pattern = F.replace(_field("pattern"), F.lit("[A-Z]"), F.lit("X"))
    evalue = _field("evalue", "double")
    hit = alignment_significant(evalue, _field("tcov", "double"))

    def parts(name: str, part: int) -> Column:
        return F.transform(
            F.array_distinct(phenotype_parts(_field("target"), part)), lambda x: _item(name, x, metric=evalue))

    none = F.expr(f"cast(array() as {ITEM})")
    domain = _field("domain_i_evalue", "double")
    items = (
        F.when(_is("effectordb") & domain_hit_counts(),
               F.array(_item("effector_matches", _field("hmm"), metric=domain)))
        .when(_is("dbcan") & domain_hit_counts(),
              F.array(_item("dbcan_matches", _field("hmm"), metric=domain)))
        .when(_is("phibase") & hit, F.concat(
            parts("phibase_ids", 1), parts("phibase_genes", 2), parts("phibase_phenotypes", 5)))
        .when(_is("kex2_cutsite"), F.array(
            _item("kex2_cutsites", _field("match"), span, start, pattern)))
        .when(_is("rxlr_like_motif"), F.array(
            _item("rxlr_like_motifs", _field("match"), span, start)))
        .otherwise(none)
    )
    return rows.select("checksum", F.inline(items))


LIST_ANALYSES = ("effectordb", "dbcan", "phibase", "kex2_cutsite", "rxlr_like_motif")
SIGNAL_ANALYSES = (*CUT_SITE_LABELS, "tmhmm")


def signal_end() -> Column:
    """End of the signal peptide that a row's tool predicts, NULL without one."""
    flag = lambda f: _field(f, "flag") == 1
    cut = _field("cs_pos")
    regions = F.transform(signal_regions(_field("topology")), lambda r: r["end"])
    return (
        F.when(_is("signalp3_nn") & flag("d_decision"), _field("ymax_pos", "int") - 1)
        .when(_is("signalp3_hmm") & flag("is_secreted"), _field("cmax_pos", "int") - 1)
        .when(_is("signalp4") & flag("decision"), _field("ymax_pos", "int") - 1)
        .when(_is("signalp5"), cut_position(cut, 2) - 1)
        .when(_is("signalp6"), cut_position(cut, 1) - 1)
        .when(_is("deepsig") & (_field("prediction") == "SignalPeptide"), _field("cs_pos", "int"))
        .when(_is("phobius") & flag("sp"), F.coalesce(F.array_max(regions), F.lit(1)))
    )


def signal_items(rows: DataFrame) -> DataFrame:
    """Signal peptides and membrane segments: ``checksum, analysis, kind, start, end``."""
    point = F.struct(F.lit("sp").alias("kind"), F.lit(0).alias("start"), signal_end().alias("end"))
    segments = F.when(
        _is("phobius") | _is("tmhmm"),
        F.transform(membrane_segments(_field("topology")), lambda s: F.struct(
            F.lit("tm").alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))
    both = F.concat(F.array(point), F.coalesce(
        segments, F.expr("cast(array() as array<struct<kind string, start int, end int>>)")))
    found = rows.select("checksum", "analysis", F.inline(both))
    return found.filter(F.col("start") < F.col("end"))


def _joined(name: str, label, repeat: bool = False) -> Column:
    """The entries of one list, in order, as text; NULL when there are none."""
    rows = F.array_sort(F.collect_list(F.when(F.col("list") == name, F.struct(
        "metric", "head", "tail", "patterns", "n"))))
    texts = F.transform(rows, lambda r: F.array_join(F.array_repeat(label(r), r["n"]), ",")
                        if repeat else label(r))
    return F.nullif(F.array_join(texts, ","), F.lit("")).alias(name)


def list_summary(results: DataFrame) -> DataFrame:
    """All list columns of evidence and motifs.

    First the distinct entries per sequence (best metric, pattern set, count), then
    the lists; the cells hold distinct entries of one sequence, nothing else is gathered.
    """
    rows = _parse(results.filter(F.col("analysis").isin(*LIST_ANALYSES)), LIST_PAYLOAD)
    entries = list_items(rows).groupBy("checksum", "list", "head", "tail").agg(
        F.min("metric").alias("metric"), F.collect_set("pattern").alias("patterns"),
        F.count(F.lit(1)).cast("int").alias("n"))
    head = lambda r: r["head"]
    names = ("effector_matches", "dbcan_matches", "phibase_ids", "phibase_genes", "phibase_phenotypes")
    return entries.groupBy("checksum").agg(
        *[_joined(n, head) for n in names],
        _joined("kex2_cutsites", lambda r: F.concat_ws(
            ":", r["head"], F.array_join(F.array_sort(r["patterns"]), "&"), r["tail"])),
        _joined("rxlr_like_motifs", lambda r: F.concat_ws(":", r["head"], r["tail"]), repeat=True),
    )


def signal_summary(results: DataFrame) -> DataFrame:
    """Cut-site and segment lists, and how far signal peptides cover the first segment."""
    rows = _parse(results.filter(F.col("analysis").isin(*SIGNAL_ANALYSES)), SIGNAL_PAYLOAD)
    items = signal_items(rows).groupBy("checksum", "analysis", "kind", "start", "end").agg(
        F.count(F.lit(1)).cast("int").alias("n"))

    def listed(condition: Column, order: list, text) -> Column:
        found = F.array_sort(F.collect_list(F.when(condition, F.struct(*order, "n"))))
        texts = F.transform(found, lambda r: F.array_join(F.array_repeat(text(r), r["n"]), ","))
        return F.nullif(F.array_join(texts, ","), F.lit(""))

    label = F.create_map(*[F.lit(x) for pair in CUT_SITE_LABELS.items() for x in pair])
    items = items.withColumn("label", F.element_at(label, F.col("analysis")))
    segment = lambda r: F.concat_ws("-", (r["start"] + 1).cast("string"), r["end"].cast("string"))
    is_tm = F.col("kind") == "tm"
    lists = items.groupBy("checksum").agg(
        listed(F.col("kind") == "sp", ["end", "label"], lambda r: F.concat_ws(
            ":", r["label"], r["end"].cast("string"))).alias("signal_peptide_cutsites"),
        F.concat(F.lit("tm:"), listed(is_tm & _is("phobius"), ["start", "end"], segment)).alias("phobius_tm_domains"),
        F.concat(F.lit("tm:"), listed(is_tm & _is("tmhmm"), ["start", "end"], segment)).alias("tmhmm_domains"),
    )
    seen = rows.select("checksum").distinct()
    return (
        seen.join(lists, "checksum", "left").join(median_overlap(items), "checksum", "left")
        .withColumn("tmhmm_first_tm_sp_coverage", F.coalesce("tmhmm_first_tm_sp_coverage", F.lit(0.0)))
    )


def median_overlap(items: DataFrame, out: str = "tmhmm_first_tm_sp_coverage") -> DataFrame:
    """Median share of the first membrane segment that signal peptides reach into.

    ``items`` holds counted ``checksum, kind, start, end, n``; sequences missing
    either kind have no row here.  The exact median is weighted by the counts.
    """
    first = items.filter(F.col("kind") == "tm").groupBy("checksum").agg(
        F.min(F.struct("start", "end")).alias("tm"))
    signals = items.filter(F.col("kind") == "sp").groupBy("checksum", "end").agg(F.sum("n").alias("n"))
    lo, hi = F.col("tm.start"), F.col("tm.end")
    covered = F.greatest(F.least(F.col("end"), hi) - F.greatest(lo, F.lit(0)), F.lit(0)) / (hi - lo)
    return (
        signals.join(first, "checksum").withColumn("share", covered)
        .groupBy("checksum").agg(F.expr("percentile(share, 0.5, n)").alias(out))
    )


def wide_summary(results: DataFrame, decoder: DataFrame,
                 members: tuple[str, ...] = VIRULENCE_DOMAINS, strict: bool = False) -> DataFrame:
    """The 73 aggregates per ``name, checksum``; with ``strict`` conflicting predictions fail the job."""
    from .store import distinct_results

    # the lists count repeats, so they need distinct rows; the maxima do not
    distinct = distinct_results(
        results.filter(F.col("analysis").isin(*LIST_ANALYSES, *SIGNAL_ANALYSES)))
    folded = (
        numeric_summary(results, members, strict)
        .join(list_summary(distinct), "checksum", "left")
        .join(signal_summary(distinct), "checksum", "left")
    )
    names = decoder.select("checksum", "name").distinct()
    return folded.join(names, "checksum")


def summary_table(results: DataFrame, decoder: DataFrame, threshold: float = 10) -> DataFrame:
    """The wide summary with the signal and membrane flags."""
    return score_flags(wide_summary(results, decoder), threshold=threshold)
