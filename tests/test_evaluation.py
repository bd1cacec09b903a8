import pytest
from conftest import rows

from tonescale.operators import evaluation, scoring
from tonescale.schemas import CLASSES

# A recorded confusion matrix over 4,838 documents (rows are true
# classes, columns predictions, both in class order) and its recorded metrics.
RECORDED_MATRIX = {
    "positive": (577, 48, 737),
    "negative": (97, 173, 334),
    "neutral": (278, 51, 2543),
}
RECORDED_METRICS = {
    "positive": (0.6061, 0.4236, 0.4987, 1362),
    "negative": (0.636, 0.2864, 0.3949, 604),
    "neutral": (0.7037, 0.8854, 0.7842, 2872),
}


@pytest.fixture(scope="module")
def counts(edge_documents, edge_lexicon):
    scored = scoring.score_corpus(edge_documents, edge_lexicon, carry=["label"])
    return evaluation.evaluation_counts(evaluation.validate_predictions(scored))


def test_edge_metrics(counts):
    assert rows(evaluation.class_metrics(counts)) == sorted(
        [
            ("positive", 0.5, 0.5, 0.5, 4),
            ("negative", 0.0, None, None, 0),
            ("neutral", 0.5, 0.3333, 0.4, 3),
        ],
        key=repr,
    )
    assert evaluation.metrics_summary(counts).first().asDict() == {
        "documents_count": 9,
        "positive_documents": 4,
        "negative_documents": 1,
        "neutral_documents": 4,
        "evaluated_documents": 7,
        "correct_predictions": 3,
        "accuracy": 0.4286,
        "avg_tokens_per_document": 3.0,
        "avg_score": 0.5556,
    }


def test_matrix_always_has_nine_cells(counts):
    matrix = evaluation.confusion_matrix(counts).collect()
    assert {(r.true_label, r.predicted_sentiment) for r in matrix} == {
        (t, p) for t in CLASSES for p in CLASSES
    }
    assert sum(r.n for r in matrix) == 7


def test_report_nests_the_same_numbers(counts):
    report = evaluation.metrics_report(counts).first()
    for row in evaluation.class_metrics(counts).collect():
        assert tuple(report.class_metrics[row.label]) == tuple(row)[1:]
    for row in evaluation.confusion_matrix(counts).collect():
        assert report.confusion_matrix[row.true_label][row.predicted_sentiment] == row.n


def test_recorded_matrix(spark):
    cells = RECORDED_MATRIX
    matrix = spark.createDataFrame(
        [(t, p, cells[t][j]) for t in CLASSES for j, p in enumerate(CLASSES)],
        "true_label string, predicted_sentiment string, n bigint",
    )
    metrics = evaluation.class_metrics(evaluation.counts_from_matrix(matrix))
    assert {r.label: tuple(r)[1:] for r in metrics.collect()} == RECORDED_METRICS


def predictions(spark, data):
    return spark.createDataFrame(
        data,
        "doc_id bigint, predicted_sentiment string, predicted string, true_label string, "
        "label string, score bigint, tokens array<string>",
    )


def test_fallbacks_and_missing_predictions(spark):
    frame = predictions(
        spark,
        [
            (1, " Positive ", None, "POSITIVE", None, 1, ["a"]),
            (2, "unsure", "negative", "mixed", "Negative", -1, ["a", "b"]),
            (3, None, None, "neutral", None, None, None),
            (4, "neutral", None, None, "mixed", 0, []),
            (None, None, None, None, None, None, None),
        ],
    )
    validated = evaluation.validate_predictions(frame)
    columns = ("doc_id", "predicted_sentiment", "true_label", "is_correct", "token_count")
    assert rows(validated, *columns) == sorted(
        [
            (1, "positive", "positive", True, 1),
            (2, "negative", "negative", True, 2),
            (3, None, "neutral", False, None),
            (4, "neutral", None, None, 0),
            (None, None, None, None, None),
        ],
        key=repr,
    )
    counts = evaluation.evaluation_counts(validated)
    summary = evaluation.metrics_summary(counts).first()
    assert (summary.documents_count, summary.evaluated_documents, summary.correct_predictions) == (5, 3, 2)
    assert (summary.accuracy, summary.avg_tokens_per_document, summary.avg_score) == (0.6667, 1.0, 0.0)
    support = {r.label: r.support for r in evaluation.class_metrics(counts).collect()}
    assert support == {"positive": 1, "negative": 1, "neutral": 0}


def test_absent_columns(spark):
    frame = spark.createDataFrame([(1, "positive")], "doc_id bigint, predicted string")
    row = evaluation.validate_predictions(frame).first()
    assert (row.predicted_sentiment, row.true_label, row.is_correct, row.score) == ("positive", None, None, None)


def test_no_rows(spark):
    counts = evaluation.evaluation_counts(evaluation.validate_predictions(predictions(spark, [])))
    summary = evaluation.metrics_summary(counts).first()
    assert (summary.accuracy, summary.avg_tokens_per_document, summary.avg_score) == (None, 0.0, None)
    assert evaluation.confusion_matrix(counts).count() == 9
