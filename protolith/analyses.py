"""The analysis registry: one entry per result kind.

Every job that needs to know a payload's columns, the conflict key of the
store, or the software behind a result, reads it here.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import types as T

# --- fixed values: payload columns per result kind, in payload order ---------
SIGNALP3_NN = (
    "name string, cmax double, cmax_pos int, cmax_decision boolean, ymax double, "
    "ymax_pos int, ymax_decision boolean, smax double, smax_pos int, "
    "smax_decision boolean, smean double, smean_decision boolean, d double, "
    "d_decision boolean"
)
SIGNALP3_HMM = (
    "name string, is_secreted boolean, cmax double, cmax_pos int, "
    "cmax_decision boolean, sprob double, sprob_decision boolean"
)
SIGNALP4 = (
    "name string, cmax double, cmax_pos int, ymax double, ymax_pos int, "
    "smax double, smax_pos int, smean double, d double, decision boolean, "
    "dmax_cut double, networks_used string"
)
SIGNALP56 = "name string, prediction string, prob_signal double, prob_other double, cs_pos string"
DEEPSIG = "name string, prediction string, prob double, cs_pos int"
PHOBIUS = "name string, tm int, sp boolean, topology string"
TMHMM = (
    "name string, length int, exp_aa double, first_60 double, pred_hel int, topology string"
)
DEEPLOC = (
    "name string, prediction string, membrane double, nucleus double, "
    "cytoplasm double, extracellular double, mitochondrion double, "
    "cell_membrane double, endoplasmic_reticulum double, plastid double, "
    "golgi_apparatus double, lysosome_vacuole double, peroxisome double"
)
DEEPLOC2 = (
    "name string, localisations array<string>, signals array<string>, "
    "cytoplasm double, nucleus double, extracellular double, "
    "cell_membrane double, mitochondrion double, plastid double, "
    "endoplasmic_reticulum double, lysosome_vacuole double, "
    "golgi_apparatus double, peroxisome double"
)
TARGETP_PLANT = (
    "name string, prediction string, other double, sp double, mtp double, "
    "ctp double, lutp double, cs_pos string"
)
TARGETP_NON_PLANT = (
    "name string, prediction string, other double, sp double, mtp double, cs_pos string"
)
PREDICTION_PROB = "name string, prediction string, prob double"
EFFECTORP3 = (
    "name string, prediction string, cytoplasmic_prob double, "
    "apoplastic_prob double, noneffector_prob double"
)
DEEPREDEFF = "name string, s_score double, prediction string"
LOCALIZER = (
    "name string, chloroplast_decision boolean, chloroplast_prob double, "
    "chloroplast_start int, chloroplast_end int, mitochondria_decision boolean, "
    "mitochondria_prob double, mitochondria_start int, mitochondria_end int, "
    "nucleus_decision boolean, nucleus_signals string"
)
PFAMSCAN = (
    "name string, ali_start int, ali_end int, env_start int, env_end int, "
    "hmm string, hmm_name string, hmm_type string, hmm_start int, hmm_end int, "
    "hmm_len int, bitscore double, evalue double, is_significant boolean, "
    "clan string, active_sites string"
)
DOMAIN_TABLE = (
    "query string, hmm string, hmm_len int, query_len int, full_evalue double, "
    "full_score double, full_bias double, nmatches int, domain_c_evalue double, "
    "domain_i_evalue double, domain_score double, domain_bias double, "
    "hmm_from int, hmm_to int, query_from int, query_to int, acc double, "
    "description string"
)
ALIGNMENT = (
    "query string, target string, qstart int, qend int, qlen int, tstart int, "
    "tend int, tlen int, evalue double, gapopen int, pident double, alnlen int, "
    "raw double, bits double, cigar string, mismatch int, qcov double, tcov double"
)
MOTIF_HIT = "name string, kind string, pattern string, match string, start int, end int"
DEEPTMHMM = "name string, prediction string, topology string"
TMBED = "name string, has_sp boolean, has_tm boolean, topology string"
PROFILE_ALIGNMENT = (
    "query_id string, query_length int, query_neff double, template_id string, "
    "template_length int, template_info string, template_neff double, "
    "query_ali string, template_ali string, confidence string, query_start int, "
    "template_start int, query_end int, template_end int, probability double, "
    "evalue double, score double, aligned_cols int, identity double, "
    "similarity double, sum_probs double"
)
RESIDUE_PROPERTIES = (
    "tiny", "small", "aliphatic", "aromatic", "nonpolar", "polar", "charged",
    "basic", "acidic",
)
# --- end of fixed values ------------------------------------------------------

RESIDUES = tuple("abcdefghijklmnopqrstuvwxyz")


def _composition_ddl() -> str:
    """Composition payload: totals, then the per-letter and per-property tables."""
    fields = [
        "name string", "molecular_weight double", "residues int",
        "average_residue_weight double", "charge double", "isoelectric_point double",
        "a280_molar_extinction_coefficients_reduced int",
        "a280_molar_extinction_coefficients_cysteine_bridges double",
        "a280_1mgml_extinction_coefficients_reduced double",
        "a280_1mgml_extinction_coefficients_cysteine_bridges double",
        "improbability_expression_inclusion_bodies double",
    ]
    for measure, kind in (("number", "int"), ("mole", "double"), ("dayhoff", "double")):
        fields += [f"residue_{aa}_{measure} {kind}" for aa in RESIDUES]
    for measure, kind in (("number", "int"), ("mole", "double")):
        fields += [f"property_{p}_{measure} {kind}" for p in RESIDUE_PROPERTIES]
    return ", ".join(fields)


PEPSTATS = _composition_ddl()


TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "array<string>": T.ArrayType(T.StringType()),
}


@lru_cache(maxsize=None)
def flat_schema(ddl: str) -> T.StructType:
    """A struct type from ``name type, ...`` without needing a session."""
    pairs = (f.strip().split(" ", 1) for f in ddl.split(","))
    return T.StructType([T.StructField(n, TYPES[t]) for n, t in pairs])


@dataclass(frozen=True)
class Analysis:
    """What the jobs know about one result kind."""

    name: str
    code: int
    software: str
    ddl: str
    database: str | None = None
    multiple_ok: bool = False
    name_column: str = "name"
    has_features: bool = True

    @property
    def schema(self) -> T.StructType:
        return flat_schema(self.ddl)

    @property
    def needs_database(self) -> bool:
        return self.database is not None


def _registry() -> dict[str, Analysis]:
    # --- fixed values: name, code, software, payload, and what differs from the default
    rows = [
        Analysis("signalp3_nn", 1, "SignalP", SIGNALP3_NN),
        Analysis("signalp3_hmm", 2, "SignalP", SIGNALP3_HMM),
        Analysis("signalp4", 3, "SignalP", SIGNALP4),
        Analysis("signalp5", 4, "SignalP", SIGNALP56),
        Analysis("deepsig", 5, "DeepSig", DEEPSIG),
        Analysis("phobius", 6, "Phobius", PHOBIUS),
        Analysis("tmhmm", 7, "TMHMM", TMHMM),
        Analysis("deeploc", 8, "DeepLoc", DEEPLOC, has_features=False),
        Analysis("targetp_plant", 9, "TargetP", TARGETP_PLANT),
        Analysis("targetp_non_plant", 10, "TargetP", TARGETP_NON_PLANT),
        Analysis("effectorp1", 11, "EffectorP", PREDICTION_PROB, has_features=False),
        Analysis("effectorp2", 12, "EffectorP", PREDICTION_PROB, has_features=False),
        Analysis("apoplastp", 13, "ApoplastP", PREDICTION_PROB, has_features=False),
        Analysis("localizer", 14, "LOCALIZER", LOCALIZER),
        Analysis("pfamscan", 15, "Pfam-scan", PFAMSCAN, "Pfam", True),
        Analysis("dbcan", 16, "HMMER", DOMAIN_TABLE, "DBCan", True, "query"),
        Analysis("phibase", 17, "MMSeqs2", ALIGNMENT, "PHIBase", True, "query"),
        Analysis("pepstats", 18, "EMBOSS", PEPSTATS, has_features=False),
        Analysis("effectordb", 19, "HMMER", DOMAIN_TABLE, "effectordb", True, "query"),
        Analysis("signalp6", 20, "SignalP", SIGNALP56),
        Analysis("effectorp3", 21, "EffectorP", EFFECTORP3, has_features=False),
        Analysis("effectorp3_fungal", 22, "EffectorP", EFFECTORP3, has_features=False),
        Analysis("regexanalysis", 23, "protolith", MOTIF_HIT, None, True),
        Analysis("deepredeff_fungi", 24, "deepredeff", DEEPREDEFF, has_features=False),
        Analysis("deepredeff_oomycete", 25, "deepredeff", DEEPREDEFF, has_features=False),
        Analysis("deepredeff_bacteria", 26, "deepredeff", DEEPREDEFF, has_features=False),
        Analysis("kex2_cutsite", 27, "protolith", MOTIF_HIT, None, True),
        Analysis("rxlr_like_motif", 28, "protolith", MOTIF_HIT, None, True),
        Analysis("deeptmhmm", 29, "DeepTMHMM", DEEPTMHMM),
        Analysis("deeploc2", 30, "DeepLoc2", DEEPLOC2, has_features=False),
        Analysis("tmbed", 31, "TMBed", TMBED),
    ]
    # --- end of fixed values
    return {a.name: a for a in rows}


ANALYSES: dict[str, Analysis] = _registry()
NEEDS_DATABASE = tuple(a.name for a in ANALYSES.values() if a.needs_database)
MULTIPLE_OK = tuple(a.name for a in ANALYSES.values() if a.multiple_ok)
WITH_FEATURES = tuple(a.name for a in ANALYSES.values() if a.has_features)

ENVELOPE = (
    "analysis string, software string, software_version string, database string, "
    "database_version string, pipeline_version string, checksum string, "
    "md5sum string, data string"
)


def analysis(name: str) -> Analysis:
    if name not in ANALYSES:
        raise ValueError(f"{name} is not a known result kind")
    return ANALYSES[name]


def choose(include: list[str] | None = None, exclude: list[str] | None = None) -> list[str]:
    """Result kinds to keep: the included ones less the excluded ones."""
    keep = list(ANALYSES) if include is None else include
    drop = set(exclude or ())
    return [analysis(n).name for n in keep if n not in drop]
