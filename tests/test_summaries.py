import pytest
from conftest import rows
from pyspark.sql import functions as F

from tonescale.operators import numbering, scoring, summaries

# Recorded chunks of 4,838 documents (documents, positive,
# negative, neutral) and their recorded totals.
RECORDED_CHUNKS = (
    (500, 302, 0, 198),
    (500, 172, 33, 295),
    (500, 58, 3, 439),
    (500, 99, 10, 391),
    (500, 93, 15, 392),
    (500, 21, 4, 475),
    (500, 28, 4, 468),
    (500, 45, 16, 439),
    (500, 64, 95, 341),
    (338, 70, 92, 176),
)
RECORDED_TOTAL = (4838, 952, 272, 3614)


@pytest.fixture(scope="module")
def scored(edge_documents, edge_lexicon):
    return scoring.score_corpus(edge_documents, edge_lexicon, carry=["label"])


def test_sentiment_summary(scored, edge_lexicon):
    assert summaries.sentiment_summary(scored, edge_lexicon).first().asDict() == {
        "documents_count": 9,
        "positive_documents": 4,
        "negative_documents": 1,
        "neutral_documents": 4,
        "evaluated_documents": 7,
        "accuracy": 0.4286,
        "lexicon_terms": 6,
    }


def test_reducer_summary_counts_any_label(scored):
    row = summaries.reducer_summary(scored).first()
    assert (row.documents_count, row.accuracy) == (9, 0.375)
    assert "evaluated_documents" not in row.asDict()


def test_empty_label_is_not_evaluated(scored):
    unlabeled = scored.withColumn("label", F.lit(""))
    assert summaries.reducer_summary(unlabeled).first().accuracy is None


def test_without_labels_or_documents(scored):
    for frame in (scored.drop("label"), scored.withColumn("label", F.lit(None).cast("string"))):
        row = summaries.summarize(frame).first()
        assert (row.documents_count, row.evaluated_documents, row.accuracy) == (9, 0, None)
    row = summaries.summarize(scored.limit(0)).first()
    assert (row.documents_count, row.accuracy) == (0, None)


@pytest.mark.parametrize("size", [1, 4, 9, 50])
def test_chunks_merge_to_the_total(scored, size):
    chunked = numbering.assign_chunks(scored, size)
    partials = summaries.partial_summary(chunked, "chunk_id")
    assert summaries.merge_partials(partials).first() == summaries.summarize(scored).first()
    sizes = [r.documents for r in partials.orderBy("chunk_id").collect()]
    assert sizes == [size] * (9 // size) + ([9 % size] if 9 % size else [])


def test_chunk_size_must_be_positive(scored):
    with pytest.raises(ValueError):
        numbering.assign_chunks(scored, 0)


def test_merge_of_recorded_counts(spark):
    parts = [(i, *chunk, 0, 0) for i, chunk in enumerate(RECORDED_CHUNKS)]
    partials = spark.createDataFrame(
        parts, "chunk_id bigint, " + ", ".join(f"{c} bigint" for c in summaries.PARTIAL_COLUMNS)
    )
    row = summaries.merge_partials(partials).first()
    assert tuple(row)[:4] == RECORDED_TOTAL
    assert summaries.merge_partials(partials.limit(0)).first().documents_count == 0


def test_positions_follow_the_key_whatever_the_partitions(spark):
    ids = [i * 37 % 1009 - 500 for i in range(1000)]
    for partitions in (1, 6):
        frame = spark.createDataFrame([(i,) for i in ids], "doc_id bigint").repartition(partitions)
        numbered = numbering.with_positions(frame, "doc_id")
        assert rows(numbered) == sorted(((k, p) for p, k in enumerate(sorted(ids))), key=repr)


@pytest.mark.parametrize("limit", [0, 10**6])
def test_offsets_are_broadcast_up_to_a_bound(spark, monkeypatch, limit):
    monkeypatch.setattr(numbering, "BROADCAST_BLOCKS", limit)
    monkeypatch.setattr(numbering, "DRIVER_BLOCKS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = numbering.with_positions(spark.range(5000, 0, -1), "id")
        plan = numbered._jdf.queryExecution().executedPlan().toString()
        assert rows(numbered) == sorted(((i, i - 1) for i in range(1, 5001)), key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("BroadcastHashJoin") == 1 + (limit > 0)  # one for the ranges of blocks


def test_positions_by_two_columns(spark):
    keys = [(c, t) for c in range(20) for t in range(c % 5 + 1)]
    numbered = numbering.with_positions(spark.createDataFrame(keys, "c int, t int"), ["c", "t"])
    assert rows(numbered) == sorted(((*k, p) for p, k in enumerate(sorted(keys))), key=repr)


def test_doc_ids_follow_file_order(spark, tmp_path):
    for i in range(3):
        lines = [f"line {i:02d} {j:04d}" for j in range(2000 + i)]
        (tmp_path / f"part-{i}.txt").write_text("\n".join(lines) + "\n")
    # Small splits: several per file, packed into tasks in any order.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        numbered = numbering.assign_doc_ids(spark.read.text(str(tmp_path)))
        found = [r.value for r in numbered.orderBy("doc_id").collect()]
        ids = [r.doc_id for r in numbered.orderBy("doc_id").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ids == list(range(1, len(ids) + 1))
    assert found == sorted(found) and len(found) == 6003


@pytest.mark.parametrize("at_driver", [0, 10_000])
def test_doc_ids_take_numbers_in_names_as_numbers(spark, monkeypatch, tmp_path, at_driver):
    monkeypatch.setattr(numbering, "DRIVER_BLOCKS", at_driver)
    names = ["part-2-a", "part-10-a", "part-0099999-a", "part-100000-a", "part-100000-b", "part-100000000000000000000000-a"]
    for name in names:
        (tmp_path / f"{name}.txt").write_text(f"{name}\n{name} again\n")
    numbered = numbering.assign_doc_ids(spark.read.text(str(tmp_path))).orderBy("doc_id").collect()
    assert [(r.doc_id, r.value) for r in numbered] == list(enumerate((t for n in names for t in (n, f"{n} again")), 1))


def test_offsets_of_many_blocks_need_no_single_partition(spark, monkeypatch):
    monkeypatch.setattr(numbering, "DRIVER_BLOCKS", 0)
    numbered = numbering.with_positions(spark.range(5000, 0, -1), "id")
    assert "SinglePartition" not in numbered._jdf.queryExecution().executedPlan().toString()
    assert rows(numbered) == sorted(((i, i - 1) for i in range(1, 5001)), key=repr)
