"""Counts stored by batches against a run over the whole corpus."""

from conftest import rows

from tonescale.operators import corpus_state
from tonescale.operators.scoring import lexicon_table, score_documents
from tonescale.operators.summaries import attach_labels, summarize
from tonescale.operators.vocabulary import corpus_summary, ranked_vocabulary


def corpus(spark):
    data = [(i, [f"w{(i * k) % 13}" for k in range(i % 6)], ["positive", None, "negative"][i % 3]) for i in range(60)]
    return spark.createDataFrame(data, "doc_id bigint, tokens array<string>, label string")


def agrees(spark, path, docs, scored):
    words = ("token", "frequency", "first_doc", "first_pos")
    assert rows(corpus_state.stored_vocabulary(spark, path), *words) == rows(ranked_vocabulary(docs), *words)
    totals = ("documents_count", "total_tokens", "unique_tokens", "avg_tokens_per_document")
    assert rows(corpus_state.stored_summary(spark, path), *totals) == rows(corpus_summary(docs), *totals)
    assert corpus_state.stored_sentiment(spark, path).first() == summarize(scored).first()


def test_batches_are_added_corrected_and_emptied(spark, tmp_path):
    path, docs = str(tmp_path / "state"), corpus(spark)
    score = score_documents(lexicon_table(spark, {"w1": 1, "w2": -1}))

    def store(part, batch):
        corpus_state.store_batch(part, path, batch)
        corpus_state.store_scores(part.transform(score), path, batch)

    for batch in (1, 0, 2):
        store(docs.filter(f"doc_id % 3 = {batch}"), batch)
    agrees(spark, path, docs, docs.transform(score))
    store(docs.filter("doc_id % 3 = 1 AND doc_id > 20"), 1)  # corrected
    agrees(spark, path, docs.filter("doc_id % 3 != 1 OR doc_id > 20"), docs.filter("doc_id % 3 != 1 OR doc_id > 20").transform(score))
    store(docs.limit(0), 2)  # taken back
    rest = docs.filter("doc_id % 3 = 0 OR doc_id % 3 = 1 AND doc_id > 20")
    agrees(spark, path, rest, rest.transform(score))
