"""Interval features from stored results."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features
from . import bindings as B
from .bindings import payload_sql as p
from .registry import job
from .summary_jobs import RES, _domain_hits

TM, SP = "transmembrane_polypeptide_region", "signal_peptide"
# kind, condition, type, start, end, score, strand
_MT = "mitochondrial_targeting_signal"
RULES = (
    ("signalp3_nn", "k >= 50", f"'{SP}'", "0", "k + 1", "k / 1e2", "+"),
    ("signalp3_hmm", "k >= 40", f"'{SP}'", "0", "k + 2", "k / 1e2", "+"),
    ("signalp4", "k >= 60", f"'{SP}'", "0", "k + 1", "v / 1e3", "+"),
    ("signalp5", "k >= 50", f"'{SP}'", "0", "k", "v / 5e1", "+"),
    ("signalp6", "k >= 50", f"'{SP}'", "0", "k", "k / 1e2", "+"),
    ("deepsig", "k % 3 = 0", f"'{SP}'", "0", "k + 1", "k / 1e2", "."),
    ("phobius", "k % 2 = 0", f"'{SP}'", "0", "k + 15", None, "."),
    ("phobius", "k % 2 = 0", "'n_terminal_region'", "0", "3", None, "."),
    ("phobius", "k % 2 = 0", "'central_hydrophobic_region_of_signal_peptide'", "3", "k + 10", None, "."),
    ("phobius", "k % 2 = 0", "'c_terminal_region'", "k + 10", "k + 15", None, "."),
    ("phobius", "TRUE", f"'{TM}'", "k + 29", "k + 50", None, "."),
    ("tmhmm", "k % 3 > 0", f"'{TM}'", "k + 4", "k + 25", None, "."),
    ("deeptmhmm", "k > 0", f"'{SP}'", "0", "k", None, "."),
    ("deeptmhmm", "TRUE", f"'{TM}'", "k + 3", "k + 23", None, "."),
    ("deeptmhmm", "k > 0", f"'{TM}'", "k + 25", "k + 25 + k", None, "."),
    ("tmbed", "k > 0", f"'{SP}'", "0", "k", None, "."),
    ("tmbed", "TRUE", f"'{TM}'", "k + 5", "k + 20", None, "."),
    ("tmbed", "k > 0", f"'{TM}'", "k + 20", "k + 20 + k", None, "."),
    ("targetp_non_plant", "k % 3 = 0", f"'{SP}'", "0", "k + 1", "v / 5e1", "."),
    ("targetp_non_plant", "k % 3 = 1", f"'{_MT}'", "0", "k + 1", "k / 1e2", "."),
    ("targetp_plant", "k % 2 = 0", f"'{SP}'", "0", "k + 1", "k / 1e2", "."),
    ("targetp_plant", "k % 2 = 1", "'transit_peptide'", "0", "90", "0.8", "."),
    ("targetp_plant", "k % 2 = 1", "'transit_peptide'", "0", "k + 1", "0.7", "."),
    ("localizer", "k % 2 = 0", "'peptide_localization_signal'", "k + 19", "k + 49", "k / 1e2", "+"),
    ("localizer", "k % 3 = 0", f"'{_MT}'", "k + 19", "k + 39", "k / 1e2", "."),
    ("pfamscan", "k % 2 = 0", "'protein_hmm_match'", "k", "k + 40", "k / 1e6", "."),
    ("dbcan", _domain_hits("dbcan"), "'protein_hmm_match'", "k", p("dbcan", "query_to"), "(k % 13) / 1e4", "."),
    ("effectordb", _domain_hits("effectordb"), "'protein_hmm_match'", "k", p("effectordb", "query_to"),
     "(k % 13) / 1e4", "."),
    ("phibase", f"{p('phibase', 'evalue')} <= 1e-5 AND k >= 50", "'protein_match'", "k", "k + 90", "(k % 12) / 1e6", "."),
    ("regexanalysis", "TRUE", "'polypeptide_motif'", "k", "k + 3", None, "+"),
    ("kex2_cutsite", "TRUE", "'propeptide_cleavage_site'", "k % 20", "k % 20 + 2", None, "+"),
    ("rxlr_like_motif", "TRUE", "'polypeptide_motif'", "k", "k + 4", None, "+"),
)


def _rules_sql() -> str:
    parts = [
        f"SELECT analysis, name AS seqid, concat_ws(':', software, software_version, database, database_version) AS source, "
        f"{type_} AS type, CAST({start} AS INT) AS start, CAST({end} AS INT) AS \"end\", "
        f"ROUND(CAST({score or 'NULL'} AS DOUBLE), 9) AS score, '{strand}' AS strand FROM res "
        f"WHERE analysis = '{kind}' AND {condition}"
        for kind, condition, type_, start, end, score, strand in RULES]
    return f"{RES} " + " UNION ALL ".join(parts)


@job("features_from_results", _rules_sql())
def features_from_results(spark, sf):
    """All features of all kinds, as one explode per result row."""
    found = features.features(B.results(spark, sf))
    return found.select("analysis", "seqid", "source", "type", "start", "end",
                        F.round("score", 9).alias("score"), "strand")
