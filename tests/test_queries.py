"""Every registered query against its SQL statement, and recorded totals."""

import pytest

import __spark_entry__ as entry
from check_queries import compare, duckdb_tables
from tonescale.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return duckdb_tables(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, tables, name):
    actual = entry.queries()[name](spark, FOLDER).toPandas()
    assert compare(actual, tables.sql(entry.oracle_sql()[name]).df()) is None


def test_every_query_has_a_statement():
    assert set(QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship_totals(spark):
    row = entry.entry(spark).first()
    assert (row.documents_count, row.evaluated_documents, row.accuracy) == (189, 82, 0.622)
    assert (row.positive_documents, row.negative_documents, row.neutral_documents) == (92, 52, 45)
    assert row.lexicon_terms == 15


def test_recorded_totals(spark):
    folder = "/root/testdata/sf0.01"
    summary = entry.queries()["metrics_summary"](spark, folder).first()
    assert (summary.documents_count, summary.correct_predictions, summary.accuracy) == (927, 212, 0.5653)
    assert (summary.avg_tokens_per_document, summary.avg_score) == (388.02, 1.5599)
    metrics = {r.label: tuple(r)[1:] for r in entry.queries()["class_metrics"](spark, folder).collect()}
    assert metrics == {
        "positive": (0.8478, 0.5571, 0.6724, 280),
        "negative": (0.2936, 0.64, 0.4025, 50),
        "neutral": (0.2927, 0.5333, 0.378, 45),
    }
    corpus = entry.queries()["corpus_summary"](spark, folder).first()
    assert (corpus.total_tokens, corpus.unique_tokens) == (359696, 68844)
