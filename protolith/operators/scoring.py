"""Flags, scores and ranking over the wide summary: column arithmetic only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: columns behind the flags and scores -------------------------
SIGNAL_COLUMNS = (
    "signalp3_nn", "signalp3_hmm", "signalp4", "signalp5", "signalp6", "deepsig", "phobius_sp",
)
OK_SIGNALS = ("signalp3_hmm", "signalp3_nn", "phobius_sp", "deepsig")
GOOD_SIGNALS = ("signalp4", "signalp5", "signalp6", "targetp_secreted")
INTRACELLULAR = (
    "deeploc_nucleus", "deeploc_cytoplasm", "deeploc_mitochondrion", "deeploc_cell_membrane",
    "deeploc_endoplasmic_reticulum", "deeploc_plastid", "deeploc_golgi", "deeploc_lysosome",
    "deeploc_peroxisome",
)
PROPORTIONS = (
    "c", "tiny", "small", "aliphatic", "aromatic", "nonpolar", "charged", "basic", "acidic",
)
MODEL_INPUTS = (
    ("molecular_weight", "double"), ("aa_c_prop", "double"), ("aa_tiny_prop", "double"),
    ("aa_small_prop", "double"), ("aa_nonpolar_prop", "double"), ("aa_basic_prop", "double"),
    ("effectorp1", "double"), ("effectorp2", "double"), ("apoplastp", "double"),
    ("phobius_tmcount", "int"), ("tmhmm_tmcount", "int"), ("tmhmm_first_60", "double"),
    ("deeploc_membrane", "double"), ("deeploc_extracellular", "double"), ("deepsig", "int"),
    ("phobius_sp", "int"), ("signalp3_nn_d", "double"), ("signalp3_hmm_s", "double"),
    ("signalp4_d", "double"), ("signalp5_prob", "double"), ("targetp_secreted_prob", "double"),
)


@dataclass(frozen=True)
class SecretionWeights:
    secreted: float = 3.0
    ok_signal: float = 0.25
    good_signal: float = 0.5
    single_transmembrane: float = -2.0
    multiple_transmembrane: float = -6.0
    deeploc_extracellular: float = 1.0
    deeploc_intracellular: float = -0.5
    deeploc_membrane: float = -1.0
    targetp_mitochondrial: float = -0.5


@dataclass(frozen=True)
class EffectorWeights:
    effectorp1: float = 3.0
    effectorp2: float = 3.0
    effectorp3_apoplastic: float = 3.0
    effectorp3_cytoplasmic: float = 3.0
    effectorp3_noneffector: float = -3.0
    deepredeff_fungi: float = 2.0
    deepredeff_oomycete: float = 2.0
    effector: float = 5.0
    virulence: float = 1.0
    lethal: float = -5.0
# --- end of fixed values ------------------------------------------------------


def _or(name: str, default: float) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(float(default)))


def _truth(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def any_signal() -> Column:
    return F.greatest(*[F.coalesce(F.col(c), F.lit(0)) for c in SIGNAL_COLUMNS]) > 0


def multiple_transmembrane(intended: bool = False) -> Column:
    """More than one segment by either caller (documented: by both)."""
    a, b = _truth(F.col("tmhmm_tmcount") > 1), _truth(F.col("phobius_tmcount") > 1)
    return (a & b) if intended else (a | b)


def single_transmembrane(threshold: float = 10, intended: bool = False) -> Column:
    """One segment.  The effective rule looks at one caller only; the documented
    rule also takes the other one unless a signal peptide explains the segment."""
    one = _truth(F.col("phobius_tmcount") == 1)
    if intended:
        other = _truth(F.col("tmhmm_tmcount") == 1)
        outside = _truth(F.col("tmhmm_first_60") < threshold)
        one = one | (other & ~any_signal()) | (other & any_signal() & outside)
    return ~multiple_transmembrane(intended) & one


def score_flags(df: DataFrame, threshold: float = 10, intended: bool = False) -> DataFrame:
    return (
        df.withColumn("any_signal_peptide", any_signal().cast("int"))
        .withColumn("multiple_transmembrane", multiple_transmembrane(intended).cast("int"))
        .withColumn("single_transmembrane", single_transmembrane(threshold, intended).cast("int"))
        .withColumn("is_secreted", (any_signal() & ~multiple_transmembrane(intended)).cast("int"))
    )


def secretion_score(w: SecretionWeights = SecretionWeights()) -> Column:
    score = _or("is_secreted", 0) * w.secreted
    for c in OK_SIGNALS:
        score = score + _or(c, 0) * w.ok_signal
    for c in GOOD_SIGNALS:
        score = score + _or(c, 0) * w.good_signal
    score = score + _or("multiple_transmembrane", 0) * w.multiple_transmembrane
    score = score + _or("single_transmembrane", 0) * w.single_transmembrane
    score = score + _or("deeploc_extracellular", 0) * w.deeploc_extracellular
    for c in INTRACELLULAR:
        score = score + _or(c, 0) * w.deeploc_intracellular
    score = score + _or("deeploc_membrane", 0) * w.deeploc_membrane
    return score + _or("targetp_mitochondrial_prob", 0) * w.targetp_mitochondrial


def effector_score(w: EffectorWeights = EffectorWeights(), intended: bool = False) -> Column:
    """Secretion score plus effector evidence.

    The effective virulence factor is the bitwise complement of the 0/1 effector
    flag, so -1 or -2; the documented one is 1 or 0.
    """
    score = F.col("manual_secretion_score")
    for c in ("effectorp1", "effectorp2"):
        score = score + (_or(c, 0.5) - 0.5) * 2 * getattr(w, c)
    for c in ("effectorp3_apoplastic", "effectorp3_cytoplasmic", "effectorp3_noneffector"):
        score = score + _or(c, 0) * getattr(w, c)
    for c in ("deepredeff_fungi", "deepredeff_oomycete"):
        score = score + (_or(c, 0.5) - 0.5) * 2 * getattr(w, c)
    homolog = (
        (_or("has_phibase_effector_match", 0) != 0) | F.col("effector_matches").isNotNull()
        | (_or("has_dbcan_virulence_match", 0) != 0)
    ).cast("int")
    factor = (1 - homolog) if intended else (-1 - homolog)
    score = score + homolog * w.effector
    score = score + factor * _or("has_phibase_virulence_match", 0) * w.virulence
    return score + _or("has_phibase_lethal_match", 0) * w.lethal


def with_scores(df: DataFrame, secretion: SecretionWeights = SecretionWeights(),
                effector: EffectorWeights = EffectorWeights(), intended: bool = False) -> DataFrame:
    return df.withColumn("manual_secretion_score", secretion_score(secretion)).withColumn(
        "manual_effector_score", effector_score(effector, intended))


def model_features(df: DataFrame, keep: tuple[str, ...] = ("name",)) -> DataFrame:
    """The model's typed inputs; composition counts become proportions."""
    wide = df
    for p in PROPORTIONS:
        wide = wide.withColumn(f"aa_{p}_prop", F.col(f"aa_{p}_number") / F.col("residue_number"))
    return wide.select(*keep, *[F.col(c).cast(t).alias(c) for c, t in MODEL_INPUTS])


def score_with_model(df: DataFrame, model, key: str = "name", out: str = "effector_score") -> DataFrame:
    """Score rows with a user's model.

    ``model`` is a ``pyspark.ml`` transformer that adds ``prediction``, or a function
    from a pandas frame of the inputs to an array, run on Arrow batches.
    """
    if hasattr(model, "transform"):
        inputs = model_features(df, tuple(df.columns)) if key in df.columns else df
        return model.transform(inputs).withColumnRenamed("prediction", out)

    features = model_features(df, (key,))
    names = [c for c, _ in MODEL_INPUTS]

    def score(batches):
        for pdf in batches:
            yield pdf[[key]].assign(**{out: model(pdf[names])})

    kind = features.schema[key].dataType.simpleString()
    return features.mapInPandas(score, f"{key} {kind}, {out} double")


def rank(df: DataFrame, by: str = "effector_score", tie: str = "name", k: int | None = None,
         digits: int = 3) -> DataFrame:
    """Best first, doubles rounded; with ``k`` only the head, which Spark plans as a top-k."""
    rounded = df.select(*[
        F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
    ordered = rounded.orderBy(F.col(by).desc_nulls_last(), F.col(tie))
    return ordered.limit(k) if k is not None else ordered
