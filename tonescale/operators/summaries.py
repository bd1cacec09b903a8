"""Totals, per-batch partials and their merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonescale.functions.labels import is_class, normalize_label
from tonescale.functions.ratios import ratio
from tonescale.operators.scoring import lexicon_size
from tonescale.schemas import CLASSES

PARTIAL_COLUMNS = ("documents", *CLASSES, "evaluated", "correct")


def attach_labels(scored: DataFrame, labels: DataFrame) -> DataFrame:
    """Left-join ``label`` by ``doc_id``; documents without one stay unlabeled."""
    return scored.join(labels.select("doc_id", "label"), "doc_id", "left")


def _label_columns(frame: DataFrame, any_label: bool) -> tuple[Column, Column]:
    """The true label to compare and whether it counts as evaluated.

    By default a label is stripped, lower-cased and must name a class.  With
    ``any_label`` it is only lower-cased and any non-empty label counts.
    """
    label = F.col("label").cast("string") if "label" in frame.columns else F.lit(None).cast("string")
    if any_label:
        true = F.lower(label)
        return true, F.coalesce(true != "", F.lit(False))
    true = normalize_label(label)
    return true, is_class(true)


def _partial_counts(frame: DataFrame, any_label: bool) -> list[Column]:
    predicted = F.col("predicted_sentiment")
    true, evaluated = _label_columns(frame, any_label)
    return [
        F.count(F.lit(1)).alias("documents"),
        *[F.count_if(predicted == name).alias(name) for name in CLASSES],
        F.count_if(evaluated).alias("evaluated"),
        F.count_if(evaluated & (true == predicted)).alias("correct"),
    ]


def partial_summary(scored: DataFrame, by: str | list[str], any_label: bool = False) -> DataFrame:
    """Counts per chunk or any other batch column."""
    keys = [by] if isinstance(by, str) else list(by)
    return scored.groupBy(*keys).agg(*_partial_counts(scored, any_label))


def _as_summary(counts: DataFrame) -> DataFrame:
    return counts.select(
        F.col("documents").alias("documents_count"),
        *[F.col(name).alias(f"{name}_documents") for name in CLASSES],
        F.col("evaluated").alias("evaluated_documents"),
        ratio(F.col("correct"), F.col("evaluated")).alias("accuracy"),
    )


def merge_partials(partials: DataFrame) -> DataFrame:
    """Total of stored partial counts; all zero, accuracy NULL, without any."""
    zero = F.lit(0).cast("bigint")
    return _as_summary(
        partials.agg(*[F.coalesce(F.sum(name), zero).alias(name) for name in PARTIAL_COLUMNS])
    )


def summarize(scored: DataFrame, any_label: bool = False) -> DataFrame:
    """One-row summary; partial counts per task, one small final merge."""
    return _as_summary(scored.agg(*_partial_counts(scored, any_label)))


def sentiment_summary(scored: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Summary with the number of lexicon terms; only the 3 classes are evaluated."""
    terms = F.lit(lexicon_size(lexicon)).cast("bigint").alias("lexicon_terms")
    return summarize(scored).select("*", terms)


def reducer_summary(scored: DataFrame) -> DataFrame:
    """Summary in which any non-empty label counts as evaluated."""
    return summarize(scored, any_label=True).drop("evaluated_documents")
