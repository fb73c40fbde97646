"""Filtered aggregate expressions for the wide summary."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def max_field(value: Column, condition: Column) -> Column:
    """Largest value among the rows of one kind."""
    return F.max(F.when(condition, value))


def clamp(value: Column) -> Column:
    """Into [0, 1]; NULL stays NULL (least and greatest alone would skip it)."""
    return F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(1.0)), F.lit(0.0)))


def max_prob(value: Column, condition: Column) -> Column:
    return clamp(max_field(value, condition))


def any_equal(value: Column, wanted: str, condition: Column) -> Column:
    """1 when some row equals, 0 when none does, NULL without rows."""
    return max_field((value == wanted).cast("int"), condition)


def prob_of_prediction(prob: Column, prediction: Column, wanted: str, condition: Column) -> Column:
    return max_prob(prob, condition & (prediction == wanted))


def member_flag(value: Column, members: list[str], condition: Column) -> Column:
    """1 when some value is in the set, else 0."""
    return F.coalesce(max_field(value.isin(*members).cast("int"), condition), F.lit(0))


def signed_prob(prob: Column, prediction: Column, positives: list[str], condition: Column) -> Column:
    """The probability when the prediction is positive, one minus it otherwise."""
    return max_field(F.when(prediction.isin(*positives), prob).otherwise(1 - prob), condition)


def signed_prob_conflict(prob: Column, prediction: Column, positives: list[str], condition: Column) -> Column:
    """Whether the rows of a group disagree."""
    signed = F.when(prediction.isin(*positives), prob).otherwise(1 - prob)
    only = F.when(condition, signed)
    return F.coalesce(F.min(only) != F.max(only), F.lit(False))


def ratio_of_sums(numerator: list[Column], denominator: list[Column]) -> Column:
    """(sum + 1) / (sum + 1); any NULL makes it NULL."""
    top = sum(numerator[1:], numerator[0])
    bottom = sum(denominator[1:], denominator[0])
    return (F.lit(1.0) * top + 1) / (F.lit(1.0) * bottom + 1)
