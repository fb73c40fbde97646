"""Result rows to interval features: zero or more per row, as column expressions.

Coordinates are 0-based and half-open.  A feature whose start is not before its
end is dropped; :func:`empty_features` lists those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..analyses import ANALYSES, WITH_FEATURES
from ..functions import topology as topo
from ..functions.attributes import (
    FEATURE, attributes, custom_from, custom_lists, gap_from_cigar, target,
)
from ..functions.significance import alignment_significant, domain_significant
from ..functions.text import bound, cut_position, cut_site, flag_text, number_text, source_tag
from .ordered import number_rows

TM = "transmembrane_polypeptide_region"
SP = "signal_peptide"
# --- fixed values: targeting peptide kind to feature type ----------------------
PLANT_TYPES = {
    "SP": SP, "mTP": "mitochondrial_targeting_signal", "cTP": "transit_peptide",
    "luTP": "transit_peptide",
}
PLANT_PROBS = (
    ("sp", "signal"), ("mtp", "mitochondrial"), ("ctp", "chloroplast"), ("lutp", "lumen"), ("other", "other"),
)
LABEL_KINDS = {"M": "alpha_helix", "B": "beta_barrel"}
# --- end of fixed values ------------------------------------------------------


def _one(type_: Column, start: Column, end: Column, score: Column | None = None,
         strand: str = ".", attrs: Column | None = None) -> Column:
    """The part of a feature that a rule decides; seqid and source come later."""
    return F.struct(
        type_.alias("type"), start.cast("int").alias("start"), end.cast("int").alias("end"),
        (F.lit(None) if score is None else score).cast("double").alias("score"),
        F.lit(strand).alias("strand"), F.lit(".").alias("phase"),
        (attributes() if attrs is None else attrs).alias("attributes"),
    )


def _texts(d: Column, kind: str, skip: tuple[str, ...] = (), extra: list | None = None) -> Column:
    """Payload columns as an attribute map, the way the payload spells them; NULLs left out.

    The doubles go through one transform, which keeps the plan small.
    """
    fields = [f for f in ANALYSES[kind].schema.fields if f.name not in skip]
    numbers = [f.name for f in fields if f.dataType.simpleString() == "double"]
    others = [(f.name, flag_text(d[f.name]) if f.dataType.simpleString() == "boolean" else d[f.name])
              for f in fields if f.name not in numbers]
    return _map(d, numbers, [*others, *(extra or [])], [f.name for f in fields])


def _map(d: Column, numbers: list[str], others: list, first: list[str]) -> Column:
    """Attribute map from double-valued fields and ready texts; keys ``first``, then the rest."""
    ready = dict(others)
    order = [*first, *[k for k in [*ready, *numbers] if k not in first]]
    return bound(
        F.transform(F.array(*[d[n] for n in numbers]), number_text),
        lambda texts: custom_lists(order, F.array(*[
            texts[numbers.index(k)] if k in numbers else ready[k].cast("string") for k in order])))


def _empty() -> Column:
    piece = FEATURE.replace("seqid: string, source: string, ", "")
    return F.expr(f"cast(array() as array<{piece}>)")


def _when(condition: Column, feature: Column) -> Column:
    return F.when(condition, F.array(feature)).otherwise(_empty())


def _scored_signal(kind: str, flag: str, position: str, score: str):
    def rule(d: Column, keep_all: bool) -> Column:
        attrs = attributes(custom=_texts(d, kind, ("name",)))
        return _when(d[flag], _one(F.lit(SP), F.lit(0), d[position] - 1, d[score], "+", attrs))
    return rule


def _cut_signal(words: int):
    def rule(d: Column, keep_all: bool) -> Column:
        cut = cut_position(d["cs_pos"], words)
        share = F.regexp_extract(d["cs_pos"], r"Pr: ([-+]?\d*\.?\d+)", 1)
        attrs = attributes(custom=_map(
            d, ["prob_signal", "prob_other"], [("prediction", d["prediction"]), ("prob_cut_site", share)],
            ["prediction", "prob_signal", "prob_other"]))
        return _when(cut.isNotNull(), _one(F.lit(SP), F.lit(0), cut - 1, d["prob_signal"], "+", attrs))
    return rule


def _deepsig(d: Column, keep_all: bool) -> Column:
    attrs = attributes(custom=_map(d, ["prob"], [("prediction", d["prediction"]), ("cs_pos", d["cs_pos"])],
                                   ["prediction", "prob"]))
    return _when((d["prediction"] == "SignalPeptide") & d["cs_pos"].isNotNull(),
                 _one(F.lit(SP), F.lit(0), d["cs_pos"], d["prob"], ".", attrs))


def _segments(found: Column) -> Column:
    return F.transform(found, lambda s: _one(F.lit(TM), s["start"], s["end"]))


def _phobius(d: Column, keep_all: bool) -> Column:
    regions = topo.signal_regions(d["topology"])
    # the running index of the record completes the id later
    marker = F.lit("signal_peptide")
    whole = F.coalesce(F.array_max(F.transform(regions, lambda r: r["end"])), F.lit(1))
    signal = F.when(d["sp"], F.array(
        _one(F.lit(SP), F.lit(0), whole, None, ".", attributes(id=marker)))).otherwise(_empty())
    parent = F.when(d["sp"], F.array(marker))
    children = F.transform(regions, lambda r: _one(
        r["type"], r["start"], r["end"], None, ".", attributes(parent=parent)))
    return F.concat(signal, children, _segments(topo.membrane_segments(d["topology"])))


def _tmhmm(d: Column, keep_all: bool) -> Column:
    return _segments(topo.membrane_segments(d["topology"]))


def _label_runs(alphabet: str, membrane: str):
    def rule(d: Column, keep_all: bool) -> Column:
        kept = F.filter(topo.runs(d["topology"], alphabet),
                        lambda r: r["symbol"].isin(*membrane, "S"))
        kind = F.create_map(*[F.lit(x) for kv in LABEL_KINDS.items() for x in kv])

        def piece(r: Column) -> Column:
            labels = F.when(r["symbol"] == "S", F.lit(None)).otherwise(F.try_element_at(kind, r["symbol"]))
            attrs = attributes(custom=custom_from([("kind", labels)])) if membrane == "MB" else None
            return _one(F.when(r["symbol"] == "S", SP).otherwise(TM), r["start"], r["end"], attrs=attrs)
        return F.transform(kept, piece)
    return rule


def _targetp(d: Column, keep_all: bool) -> Column:
    cut = cut_position(d["cs_pos"], 2)
    is_sp = d["prediction"] == "SP"
    probs = F.struct(d["sp"].alias("prob_signal"), d["mtp"].alias("prob_mitochondrial"),
                     d["other"].alias("prob_other"))
    share = F.regexp_extract(d["cs_pos"], r"Pr: ([-+]?\d*\.?\d+)", 1)
    attrs = attributes(custom=_map(
        probs, ["prob_signal", "prob_mitochondrial", "prob_other"],
        [("prediction", d["prediction"]), ("prob_cut_site", share)],
        ["prediction", "prob_signal", "prob_mitochondrial", "prob_other"]))
    type_ = F.when(is_sp, SP).otherwise("mitochondrial_targeting_signal")
    return _when(
        cut.isNotNull() & d["prediction"].isin("SP", "mTP") & ~d["cs_pos"].contains("Probable protein fragment"),
        _one(type_, F.lit(0), cut - 1, F.when(is_sp, d["sp"]).otherwise(d["mtp"]), ".", attrs))


def _targetp_plant(d: Column, keep_all: bool) -> Column:
    types = F.create_map(*[F.lit(x) for kv in PLANT_TYPES.items() for x in kv])
    by_prediction = (
        F.when(d["prediction"] == "SP", d["sp"]).when(d["prediction"] == "mTP", d["mtp"])
        .when(d["prediction"] == "cTP", d["ctp"]).when(d["prediction"] == "luTP", d["lutp"]))
    sites = F.filter(F.transform(F.split(d["cs_pos"], ";"), lambda c: cut_site(F.trim(c))),
                     lambda c: c.isNotNull() & c["kind"].isin("", "luTP", "cTP", "mTP", "SP"))

    def piece(c: Column) -> Column:
        kind = F.nullif(c["kind"], F.lit(""))
        share = c["prob"]
        probs = F.struct(*[d[f].alias(f"prob_{n}") for f, n in PLANT_PROBS])
        attrs = attributes(custom=_map(
            probs, [f"prob_{n}" for _, n in PLANT_PROBS],
            [("prediction", d["prediction"]), ("prob_cut_site", share), ("kind", kind)],
            ["prediction", *[f"prob_{n}" for _, n in PLANT_PROBS]]))
        type_ = F.try_element_at(types, F.coalesce(kind, d["prediction"]))
        score = F.when(kind.isNotNull(), share.try_cast("double")).otherwise(by_prediction)
        return _one(type_, F.lit(0), c["next"] - 1, score, ".", attrs)

    pieces = F.filter(F.transform(sites, piece), lambda f: f["type"].isNotNull())
    return F.when(d["cs_pos"].isNotNull() & ~d["cs_pos"].contains("Probable protein fragment"),
                  pieces).otherwise(_empty())


def _localizer(d: Column, keep_all: bool) -> Column:
    def part(organ: str, label: str, type_: str, strand: str) -> Column:
        score = d[f"{organ}_prob"]
        attrs = attributes(
            note=F.array(F.lit(f"Putative internal {label} localization peptide")),
            custom=_map(d.withField("prob", score), ["prob"], [], ["prob"]))
        return _when(d[f"{organ}_decision"], _one(
            F.lit(type_), d[f"{organ}_start"], d[f"{organ}_end"], score, strand, attrs))
    return F.concat(
        part("chloroplast", "chloroplast", "peptide_localization_signal", "+"),
        part("mitochondria", "mitochondrial", "mitochondrial_targeting_signal", "."))


def _domain(d: Column, keep_all: bool) -> Column:
    keep = F.lit(True) if keep_all else domain_significant(
        d["hmm_from"], d["hmm_to"], d["hmm_len"], d["query_from"], d["query_to"], d["domain_i_evalue"])
    texts = _texts(d, "dbcan", ("query", "hmm", "hmm_from", "hmm_to", "query_from", "query_to", "description"),
                   [("description", F.coalesce(d["description"], F.lit("None")))])
    attrs = attributes(target=target(d["hmm"], d["hmm_from"], d["hmm_to"]), custom=texts)
    return _when(keep, _one(F.lit("protein_hmm_match"), d["query_from"], d["query_to"],
                            d["domain_i_evalue"], ".", attrs))


def _pfam(d: Column, keep_all: bool) -> Column:
    texts = _texts(d, "pfamscan", (
        "name", "ali_start", "ali_end", "hmm", "hmm_start", "hmm_end", "active_sites"))
    sites = F.transform(F.split(F.translate(d["active_sites"], "[]", ",,"), ","), lambda c: F.trim(c))
    extra = F.when(d["active_sites"].isNotNull(), F.create_map(F.lit("active_sites"), F.filter(
        sites, lambda s: s != ""))).otherwise(F.expr("cast(map() as map<string, array<string>>)"))
    attrs = attributes(
        target=target(d["hmm"], d["hmm_start"], d["hmm_end"]),
        custom=F.map_concat(texts, extra))
    return _when(F.lit(True) if keep_all else d["is_significant"], _one(
        F.lit("protein_hmm_match"), d["ali_start"], d["ali_end"], d["evalue"], ".", attrs))


def _alignment(d: Column, keep_all: bool) -> Column:
    keep = F.lit(True) if keep_all else alignment_significant(d["evalue"], d["tcov"])
    texts = _texts(d, "phibase", (
        "query", "target", "qstart", "qend", "qlen", "tstart", "tend", "cigar"))
    attrs = attributes(target=target(d["target"], d["tstart"], d["tend"]),
                       gap=gap_from_cigar(d["cigar"]), custom=texts)
    return _when(keep, _one(F.lit("protein_match"), d["qstart"], d["qend"], d["evalue"], ".", attrs))


def _motif(d: Column, keep_all: bool) -> Column:
    attrs = attributes(custom=custom_from([
        ("kind", d["kind"]), ("pattern", d["pattern"]), ("match", d["match"])]))
    type_ = F.when(d["kind"] == "kex2_cutsite", "propeptide_cleavage_site").otherwise("polypeptide_motif")
    return F.array(_one(type_, d["start"], d["end"], None, "+", attrs))


RULES = {
    "signalp3_nn": _scored_signal("signalp3_nn", "d_decision", "ymax_pos", "d"),
    "signalp3_hmm": _scored_signal("signalp3_hmm", "is_secreted", "cmax_pos", "sprob"),
    "signalp4": _scored_signal("signalp4", "decision", "ymax_pos", "d"),
    "signalp5": _cut_signal(2),
    "signalp6": _cut_signal(1),
    "deepsig": _deepsig,
    "phobius": _phobius,
    "tmhmm": _tmhmm,
    "deeptmhmm": _label_runs("IOPMBS", "MB"),
    "tmbed": _label_runs("BbHhS.", "BbHh"),
    "targetp_non_plant": _targetp,
    "targetp_plant": _targetp_plant,
    "localizer": _localizer,
    "dbcan": _domain,
    "effectordb": _domain,
    "pfamscan": _pfam,
    "phibase": _alignment,
    "regexanalysis": _motif,
    "kex2_cutsite": _motif,
    "rxlr_like_motif": _motif,
}
assert set(RULES) == set(WITH_FEATURES)


def _bound(payload: Column, rule, keep_all: bool) -> Column:
    """Apply a rule; the one-element transform parses the payload once for it."""
    return F.flatten(F.transform(F.array(payload), lambda p: rule(p, keep_all)))


def _found(keep_all: bool) -> Column:
    """The rule of the row's own kind; the others are not evaluated."""
    out = None
    for name, rule in RULES.items():
        kind = ANALYSES[name]
        d = F.from_json("data", kind.schema)
        found = _bound(d, rule, keep_all)
        out = F.when(F.col("analysis") == name, found) if out is None else out.when(
            F.col("analysis") == name, found)
    return out


def features(results: DataFrame, keep_all: bool = False, name: str = "name",
             counter: str | None = None) -> DataFrame:
    """All features of result rows, with any other columns carried along.

    ``name`` is the sequence id column.  ``counter`` is the running number of the
    record inside its kind (see :func:`with_running_id`); it completes generated ids.
    """
    rows = results.filter(F.col("analysis").isin(*RULES))
    sv = F.col("software_version")
    tag = source_tag(F.col("software"), sv, F.col("database"), F.col("database_version"))
    number = F.col(counter).cast("string") if counter else F.lit("1")
    found = rows.select(
        "*", tag.alias("source"), number.alias("__no"), F.inline(_found(keep_all)))
    a = F.col("attributes")
    numbered = a.withField("id", F.concat(a["id"], F.col("__no"))).withField(
        "parent", F.transform(a["parent"], lambda p: F.concat(p, F.col("__no"))))
    return (
        found.filter(F.col("start") < F.col("end"))
        .withColumn("attributes", numbered)
        .withColumn("seqid", F.col(name))
        .select("analysis", "seqid", "source", "type", "start", "end", "score", "strand", "phase",
                "attributes")
    )


def empty_features(results: DataFrame, name: str = "name") -> DataFrame:
    """Features that were dropped because they have no length."""
    rows = results.filter(F.col("analysis").isin(*RULES))
    return rows.select(
        "analysis", F.col(name).alias("seqid"), F.inline(_found(True))
    ).filter(F.col("start") >= F.col("end")).select("analysis", "seqid", "type", "start", "end")


def with_running_id(results: DataFrame, order: list, out: str = "running_id") -> DataFrame:
    """Number the records of each kind from 1, in arrival order."""
    numbered = number_rows(results, order, out=out, keys=["analysis"])
    return numbered.withColumn(out, F.col(out) + 1)
