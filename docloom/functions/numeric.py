"""Number comparisons as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def relative_diff(a: Column, b: Column) -> Column:
    """|a - b| over the mean magnitude; 0 when both are 0."""
    mean = (F.abs(a) + F.abs(b)) / 2
    return F.when((a == 0) & (b == 0), 0.0).otherwise(F.try_divide(F.abs(a - b), mean))


def within(predicted: Column, truth: Column, tolerance: float = 0.05) -> Column:
    """Whether a prediction lies within a share of the truth (of 1 at least)."""
    return F.abs(predicted - truth) / F.greatest(F.abs(truth), F.lit(1.0)) < tolerance


def matches_exactly(predicted: Column, truth: Column, tolerance: float = 0.0) -> Column:
    """Relative match, 0 matching only 0; nulls never match."""
    near = F.when(truth == 0, predicted == 0).otherwise(F.try_divide(F.abs(predicted - truth), F.abs(truth)) <= tolerance)
    return F.coalesce(near, F.lit(False))


def confidence_product(ocr: Column, parse: Column, match: Column) -> Column:
    return ocr * parse * match
