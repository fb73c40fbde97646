"""Which hits count as significant."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def domain_significant(
    model_from: Column, model_to: Column, model_len: Column,
    query_from: Column, query_to: Column, evalue: Column,
    short: float = 1e-3, long: float = 1e-5, coverage: float = 0.3, span: int = 80,
) -> Column:
    """Enough of the model covered, and an e-value that depends on the hit's length."""
    covered = (model_to - model_from) / model_len
    return (
        F.when(covered < coverage, False)
        .when((query_to - query_from) > span, evalue < long)
        .otherwise(evalue < short)
    )


def alignment_significant(
    evalue: Column, target_coverage: Column, max_evalue: float = 1e-5, min_coverage: float = 0.5
) -> Column:
    return (evalue <= max_evalue) & (target_coverage >= min_coverage)
