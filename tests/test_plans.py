"""Shapes of physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from tonescale.operators import documents as docs_ops
from tonescale.operators import scoring, summaries
from tonescale.operators import vocabulary as words
from tonescale.plans import inputs

FOLDER = "/root/testdata/sf0.01"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def corpus(spark):
    # Straight from the file: the spreading of small inputs is not part of the plans.
    return spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def lexicon(spark):
    return inputs.test_lexicon(spark)


@pytest.mark.parametrize("form,shuffles", [("literal", 1), ("broadcast", 2)])
def test_corpus_scoring_reads_once_and_shuffles_no_text(corpus, lexicon, form, shuffles):
    text = plan(scoring.score_corpus(corpus, lexicon, form))
    assert text.count("FileScan") == 1
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert len(exchanges) == shuffles
    assert "SortAggregate" not in text and "SortMergeJoin" not in text
    # Below the last exchange only numbers and the digest remain.
    assert re.search(r"partial_min\(doc_id", text) and not re.search(r"first\(text|max\(text#", text)


def test_literal_form_adds_no_shuffle(corpus, lexicon):
    scored = docs_ops.clean_documents(corpus).transform(scoring.score_documents(lexicon))
    assert "Exchange" not in plan(scored)


def test_summary_ends_in_one_small_exchange(corpus, lexicon):
    text = plan(summaries.summarize(scoring.score_corpus(corpus, lexicon)))
    assert text.count("Exchange SinglePartition") == 1
    assert "partial_count(if" in text or "partial_count(" in text


def test_dedup_hashes_ids_and_keeps_their_partitioning(corpus):
    text = plan(docs_ops.prepare_documents(corpus))
    assert "ShuffledHashJoin" in text and "LeftSemi, BuildRight" in text
    assert "Window" not in text and "SortMergeJoin" not in text
    grouped = docs_ops.prepare_documents(corpus).groupBy("doc_id").count()
    assert plan(grouped).count("Exchange hashpartitioning(doc_id") == 2


@pytest.mark.parametrize("build", [words.vocabulary, words.ranked_vocabulary, words.corpus_summary])
def test_exploding_does_not_clean_twice(corpus, build):
    text = plan(build(docs_ops.prepare_documents(corpus)))
    assert text.count("split(") == 1
    assert "SortAggregate" not in text


def test_top_words_takes_ordered(corpus):
    assert "TakeOrderedAndProject" in plan(words.top_words(docs_ops.prepare_documents(corpus)))


def test_shuffled_form_broadcasts_only_hot_tokens(corpus, lexicon, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scores = scoring.shuffled_scores(docs_ops.prepare_documents(corpus), lexicon)
        text = plan(scores)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("BroadcastHashJoin") == 2  # once for either side of the union
    assert "SortMergeJoin" in text


def test_small_inputs_are_spread_and_large_ones_left_alone(spark):
    from tonescale.runtime import fill_cores

    cores = spark.sparkContext.defaultParallelism
    small = spark.range(100).coalesce(1).withColumnRenamed("id", "doc_id")
    assert fill_cores(small, "doc_id").rdd.getNumPartitions() == cores
    large = spark.range(0, 100, 1, cores + 1).withColumnRenamed("id", "doc_id")
    assert fill_cores(large, "doc_id") is large


def test_results_do_not_depend_on_shuffle_partitions(spark, corpus, lexicon):
    def total():
        scored = scoring.score_corpus(corpus, lexicon).withColumn("h", F.xxhash64("doc_id", "score"))
        return scored.agg(F.count("*"), F.sum(F.col("h") % 1000), F.sum("score")).first()

    before = total()
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert total() == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
