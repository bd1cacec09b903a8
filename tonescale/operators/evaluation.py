"""Predictions against true labels.

One aggregate produces every count, the nine confusion cells included, so all
reports are arithmetic on a single row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonescale.functions.labels import class_label
from tonescale.functions.ratios import f1_score, ratio
from tonescale.schemas import CLASSES

_OPTIONAL = ("score", "positive_hits", "negative_hits")


def _first_class(frame: DataFrame, *names: str) -> Column:
    """Class in the first named column that holds one; absent columns count as NULL."""
    found = [class_label(F.col(name).cast("string")) for name in names if name in frame.columns]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def validate_predictions(predictions: DataFrame) -> DataFrame:
    """Normalized prediction, true label and ``is_correct`` per document.

    A row with a true label but no valid prediction is incorrect, not unknown.
    """
    columns = predictions.columns
    predicted = _first_class(predictions, "predicted_sentiment", "predicted")
    true = _first_class(predictions, "true_label", "label")
    sizes = {
        "tokens": F.when(F.col("tokens").isNotNull(), F.size("tokens")).cast("bigint"),
        "token_count": F.col("token_count").cast("bigint"),
    }
    known = [size for name, size in sizes.items() if name in columns]
    size = F.coalesce(*known, F.lit(None).cast("bigint"))
    return predictions.select(
        "doc_id",
        predicted.alias("predicted_sentiment"),
        *[
            (F.col(name) if name in columns else F.lit(None)).cast("bigint").alias(name)
            for name in _OPTIONAL
        ],
        size.alias("token_count"),
        true.alias("true_label"),
    ).withColumn(
        "is_correct",
        F.when(
            F.col("true_label").isNotNull(),
            F.col("predicted_sentiment").eqNullSafe(F.col("true_label")),
        ),
    )


def _cell(true: str, predicted: str) -> str:
    return f"{true}_as_{predicted}"


CELLS = tuple((true, predicted) for true in CLASSES for predicted in CLASSES)


def evaluation_counts(validated: DataFrame) -> DataFrame:
    """All counts and sums of an evaluation as one row."""
    true, predicted = F.col("true_label"), F.col("predicted_sentiment")
    return validated.agg(
        F.count(F.lit(1)).alias("documents_count"),
        *[F.count_if(predicted == name).alias(f"{name}_documents") for name in CLASSES],
        F.count("true_label").alias("evaluated_documents"),
        F.count_if("is_correct").alias("correct_predictions"),
        F.sum("token_count").alias("tokens"),
        F.count("token_count").alias("tokens_known"),
        F.sum("score").alias("scores"),
        F.count("score").alias("scores_known"),
        *[F.count_if((true == t) & (predicted == p)).alias(_cell(t, p)) for t, p in CELLS],
    )


def counts_from_matrix(matrix: DataFrame) -> DataFrame:
    """The confusion cells of a stored (true_label, predicted_sentiment, n) table."""
    true, predicted = F.col("true_label"), F.col("predicted_sentiment")
    zero = F.lit(0).cast("bigint")
    return matrix.agg(
        *[
            F.coalesce(F.sum(F.when((true == t) & (predicted == p), F.col("n"))), zero).alias(_cell(t, p))
            for t, p in CELLS
        ]
    )


def confusion_matrix(counts: DataFrame) -> DataFrame:
    """The nine cells as rows, zeros included."""
    cells = [
        F.struct(
            F.lit(t).alias("true_label"),
            F.lit(p).alias("predicted_sentiment"),
            F.col(_cell(t, p)).alias("n"),
        )
        for t, p in CELLS
    ]
    return counts.select(F.inline(F.array(*cells)))


def _class_row(name: str) -> dict[str, Column]:
    hits = F.col(_cell(name, name))
    predicted = sum((F.col(_cell(t, name)) for t in CLASSES[1:]), F.col(_cell(CLASSES[0], name)))
    actual = sum((F.col(_cell(name, p)) for p in CLASSES[1:]), F.col(_cell(name, CLASSES[0])))
    precision, recall = ratio(hits, predicted), ratio(hits, actual)
    return {
        "precision": precision,
        "recall": recall,
        "f1": f1_score(precision, recall),
        "support": actual,
    }


def class_metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class.

    Totals run over the cells, so rows without a valid prediction count in none.
    """
    rows = [
        F.struct(
            F.lit(name).alias("label"),
            *[value.alias(column) for column, value in _class_row(name).items()],
        )
        for name in CLASSES
    ]
    return counts.select(F.inline(F.array(*rows)))


def _scalar_columns() -> list[Column]:
    mean_tokens = ratio(F.col("tokens"), F.col("tokens_known"), 2)
    return [
        F.col("documents_count"),
        *[F.col(f"{name}_documents") for name in CLASSES],
        F.col("evaluated_documents"),
        F.col("correct_predictions"),
        ratio(F.col("correct_predictions"), F.col("evaluated_documents")).alias("accuracy"),
        F.coalesce(mean_tokens, F.lit(0.0)).alias("avg_tokens_per_document"),
        ratio(F.col("scores"), F.col("scores_known")).alias("avg_score"),
    ]


def metrics_summary(counts: DataFrame) -> DataFrame:
    return counts.select(*_scalar_columns())


def metrics_report(counts: DataFrame) -> DataFrame:
    """One row with the scalar metrics, ``class_metrics`` and ``confusion_matrix``."""
    per_class, matrix = [], []
    for name in CLASSES:
        values = [value.alias(column) for column, value in _class_row(name).items()]
        per_class += [F.lit(name), F.struct(*values)]
        row = []
        for p in CLASSES:
            row += [F.lit(p), F.col(_cell(name, p))]
        matrix += [F.lit(name), F.create_map(*row)]
    return counts.select(
        *_scalar_columns(),
        F.create_map(*per_class).alias("class_metrics"),
        F.create_map(*matrix).alias("confusion_matrix"),
    )
