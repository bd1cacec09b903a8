"""Rounded ratios that are NULL, not an error, on an empty denominator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column, places: int = 4) -> Column:
    return F.round(F.try_divide(numerator.cast("double"), denominator), places)


def f1_score(precision: Column, recall: Column) -> Column:
    """From the rounded precision and recall; NULL when undefined or both 0."""
    return F.round(F.try_divide(2 * precision * recall, precision + recall), 4)
