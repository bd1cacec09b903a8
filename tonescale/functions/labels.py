"""Sentiment classes: from scores and from free-form labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonescale.functions.text import strip
from tonescale.schemas import CLASSES


def score_to_label(score: Column) -> Column:
    return F.when(score > 0, "positive").when(score < 0, "negative").otherwise("neutral")


def normalize_label(label: Column) -> Column:
    """Stripped, lower-case label of any kind."""
    return F.lower(strip(label))


def class_label(label: Column) -> Column:
    """The label when it names one of the three classes, else NULL."""
    name = normalize_label(label)
    return F.when(name.isin(*CLASSES), name)


def is_class(label: Column) -> Column:
    return F.coalesce(label.isin(*CLASSES), F.lit(False))
