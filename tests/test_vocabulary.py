from collections import Counter

from conftest import rows
from pyspark.sql import functions as F

from tonescale.operators import documents as docs_ops
from tonescale.operators import vocabulary as words


def prepared(spark, texts, start=1):
    docs = spark.createDataFrame(list(enumerate(texts, start)), "doc_id bigint, text string")
    return docs_ops.prepare_documents(docs)


TEXTS = ["b a a c", "c b d d d", "e e e a", "f g"]


def counted():
    counter = Counter()
    for text in TEXTS:
        counter.update(text.split())
    return counter


def test_order_ties_by_first_occurrence(spark):
    ranked = words.ranked_vocabulary(prepared(spark, TEXTS)).orderBy(*words.frequency_order())
    assert [(r.token, r.frequency) for r in ranked.collect()] == counted().most_common()


def test_first_occurrence_with_negative_and_large_ids(spark):
    low, high = -(2**63), 2**63 - 1
    docs = spark.createDataFrame(
        [(high, ["x", "z"]), (low, ["y", "x", "y"]), (-1, ["z"])], "doc_id bigint, tokens array<string>"
    )
    ranked = words.ranked_vocabulary(docs)
    assert rows(ranked, "token", "frequency", "first_doc", "first_pos") == [
        ("x", 2, low, 1),
        ("y", 2, low, 0),
        ("z", 2, -1, 0),
    ]


def test_top_words(spark):
    top = words.top_words(prepared(spark, TEXTS), k=4)
    expected = [(i, *word) for i, word in enumerate(counted().most_common(4), 1)]
    assert rows(top, "rank", "token", "frequency") == expected


def test_corpus_summary_and_report(spark):
    docs = prepared(spark, TEXTS)
    assert words.corpus_summary(docs).first().asDict() == {
        "documents_count": 4,
        "total_tokens": 15,
        "unique_tokens": 7,
        "avg_tokens_per_document": 3.75,
    }
    report = words.corpus_report(docs, "texts.csv").first()
    assert report.input_file == "texts.csv" and report.total_tokens == 15
    assert [tuple(w) for w in report.top_20_words] == counted().most_common(20)


def test_no_documents(spark):
    none = prepared(spark, TEXTS).limit(0)
    assert tuple(words.corpus_summary(none).first()) == (0, 0, 0, 0.0)
    assert words.vocabulary(none).count() == 0
    assert words.top_words(none).count() == 0


def test_documents_without_tokens_count_as_documents(spark):
    docs = spark.createDataFrame([(1, []), (2, ["a"])], "doc_id bigint, tokens array<string>")
    assert tuple(words.corpus_summary(docs).first()) == (2, 1, 1, 0.5)
    assert rows(words.vocabulary(docs)) == [("a", 1)]
    assert words.ranked_vocabulary(docs).filter(F.col("token").isNull()).count() == 0
