import pytest
from conftest import rows
from pyspark.sql import functions as F

from tonescale.operators import documents as ops


def test_prepare_edge_rows(edge_documents):
    prepared = ops.prepare_documents(edge_documents)
    assert rows(prepared, "doc_id", "tokens") == sorted(
        [
            (1, ["profit", "rose", "strongly"]),
            (3, ["profit", "rose", "strongly"]),
            (6, ["nan"]),
            (8, ["up", "down", "x"]),
            (9, ["don", "t", "re", "enter", "3", "5"]),
            (10, ["“strong”", "–", "growth"]),
            (11, ["loss", "loss", "profit"]),
            (12, ["profit", "loss"]),
            (14, ["café", "über", "straße"]),
        ],
        key=repr,
    )
    totals = prepared.agg(F.count("*"), F.sum("token_count")).first()
    assert tuple(totals) == (9, 27)


def test_label_of_the_kept_row_wins(edge_documents):
    kept = {r.doc_id: r.label for r in ops.prepare_documents(edge_documents).collect()}
    assert kept[1] == "positive" and kept[6] == "positive"


def test_counters(edge_documents):
    row = ops.preprocess_counters(edge_documents).first()
    assert row.asDict() == {
        "rows_in": 14,
        "blank_removed": 2,
        "duplicates_removed": 2,
        "empty_removed": 1,
        "rows_out": 9,
    }


def test_counters_without_documents(edge_documents):
    assert tuple(ops.preprocess_counters(edge_documents.limit(0)).first()) == (0, 0, 0, 0, 0)


def test_null_policy_drop(edge_documents):
    ids = {r.doc_id for r in ops.prepare_documents(edge_documents, null_policy="drop").collect()}
    assert 6 not in ids and len(ids) == 8
    with pytest.raises(ValueError):
        ops.prepare_documents(edge_documents, null_policy="keep")


def test_unique_documents_keep_punctuation_only_texts(edge_documents):
    ids = {r.doc_id for r in ops.unique_documents(edge_documents).collect()}
    assert ids == {1, 3, 5, 6, 8, 9, 10, 11, 12, 14}


def test_dedup_is_idempotent_and_independent_of_partitions(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        # A third of all rows is one text; the others repeat in groups.
        F.when(F.col("id") % 3 == 0, F.lit("hot text"))
        .otherwise(F.concat(F.lit("text "), F.col("id") % 500))
        .alias("text"),
    )
    expected = {}
    for r in docs.collect():
        expected[r.text] = min(r.doc_id, expected.get(r.text, r.doc_id))
    once = ops.drop_duplicates(docs.repartition(7))
    assert {r.text: r.doc_id for r in once.collect()} == expected
    assert once.count() == len(expected) == ops.drop_duplicates(once.repartition(3)).count()


def test_preview(edge_documents):
    preview = ops.preview_documents(edge_documents, rows=3)
    assert rows(preview, "doc_id") == [(1,), (3,), (6,)]


def test_repeated_and_missing_ids(spark):
    data = [(5, "a"), (5, "a"), (5, "b"), (3, "b"), (None, "a"), (None, "c"), (None, "c"), (5, "d"), (None, "e")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string").repartition(3)
    expected = sorted([(5, "a"), (3, "b"), (None, "c"), (5, "d"), (None, "e")], key=repr)
    assert rows(ops.drop_duplicates(docs)) == expected
    assert rows(ops.prepare_documents(docs), "doc_id", "text") == expected
    assert rows(ops.preview_documents(docs, rows=9), "doc_id", "text") == expected
    assert rows(ops.preview_documents(docs, rows=3), "doc_id", "text") == sorted([(3, "b"), (5, "a"), (5, "d")], key=repr)
    assert ops.preprocess_counters(docs).first().rows_out == len(expected)
