import pytest
from conftest import rows
from pyspark.errors import PySparkException

from tonescale.operators.reconcile import differing_buckets, reconcile, reconcile_by_digest

SCHEMA = "doc_id bigint, score bigint, predicted_sentiment string, version int"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_equal_scorings_give_nothing(spark):
    left = frame(spark, [(1, 2, "positive", 1), (2, 0, "neutral", 1)])
    assert reconcile(left, left.repartition(3)).count() == 0


def test_differences_and_missing_documents(spark):
    left = frame(spark, [(1, 2, "positive", 1), (2, 0, "neutral", 1), (3, -1, "negative", 1), (5, None, None, 1)])
    right = frame(spark, [(1, 2, "neutral", 1), (2, 1, "neutral", 1), (4, 0, "neutral", 1)])
    result = reconcile(left, right).select("doc_id", "left_score", "right_score", "left_label", "right_label")
    assert rows(result) == sorted(
        [
            (1, 2, 2, "positive", "neutral"),
            (2, 0, 1, "neutral", "neutral"),
            (3, -1, None, "negative", None),
            (4, None, 0, None, "neutral"),
            (5, None, None, None, None),
        ],
        key=repr,
    )


def test_repeated_ids_fail_or_take_the_last(spark):
    left = frame(spark, [(1, 2, "positive", 1), (1, -1, "negative", 2)])
    right = frame(spark, [(1, -1, "negative", 1)])
    with pytest.raises(PySparkException, match="repeated on the left"):
        reconcile(left, right).collect()
    assert reconcile(left, right, order="version").count() == 0


def test_digests_find_what_the_join_finds(spark):
    left = [(i, i % 5 - 2, "neutral" if i % 3 else None, 1) for i in range(3000)] + [(None, None, None, 1)]
    right = [(i, s + (i % 701 == 0), c, 1) for i, s, c, _ in left[:-1] if i % 997] + [(5000, 0, "neutral", 1), (None, 0, None, 1)]
    one, two = frame(spark, left), frame(spark, right).repartition(5)
    names = ("doc_id", "left_score", "right_score", "left_label", "right_label")
    found = rows(reconcile_by_digest(one, two), *names)
    assert found == rows(reconcile(one, two), *names) and len(found) > 8
    assert differing_buckets(one, two).count() <= len(found)
    assert reconcile_by_digest(one, one.repartition(3)).count() == 0
    with pytest.raises(PySparkException, match="repeated on the left"):
        reconcile_by_digest(one.union(one), two).collect()


def test_equal_tables_shuffle_checksums_only(spark, tmp_path):
    path = str(tmp_path / "scores")
    frame(spark, [(i, i, "positive", 1) for i in range(2000)]).write.parquet(path)
    found = reconcile_by_digest(spark.read.parquet(path), spark.read.parquet(path).repartition(3))
    assert found.collect() == []
    final = found._jdf.queryExecution().executedPlan().toString()
    final = final[: final.index("Initial Plan")] if "Initial Plan" in final else final
    # no exchange by doc_id was run: nothing differed, so the joins of rows are gone
    assert "hashpartitioning(doc_id" not in final


def test_null_and_absent_values_are_told_apart(spark):
    left = frame(spark, [(1, None, "neutral", 1), (2, 0, None, 1)])
    right = frame(spark, [(1, 0, "neutral", 1), (2, 0, "neutral", 1)])
    assert reconcile_by_digest(left, right).count() == 2
