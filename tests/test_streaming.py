import pytest
from conftest import rows
from pyspark.sql import functions as F

from tonescale.operators import documents as docs_ops
from tonescale.operators import scoring, summaries
from tonescale.sources.records import load_partials
from tonescale.streaming.scoring import partials_writer, score_stream, scored_writer

COLUMNS = ("doc_id", "score", "positive_hits", "negative_hits", "predicted_sentiment", "tokens")


def arriving(spark, docs, folder, files):
    """Store documents as several files and read them as a stream, one per batch."""
    docs.repartition(files).write.parquet(str(folder))
    reader = spark.readStream.schema("doc_id bigint, text string, label string")
    return reader.option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_stream_equals_batch(spark, edge_documents, edge_lexicon, tmp_path):
    stream = score_stream(arriving(spark, edge_documents, tmp_path / "in", 3), edge_lexicon)
    assert stream.isStreaming
    query = stream.writeStream.format("memory").queryName("scored_stream").start()
    query.processAllAvailable()
    query.stop()
    batch = docs_ops.clean_documents(edge_documents).transform(scoring.score_documents(edge_lexicon))
    assert rows(spark.table("scored_stream"), *COLUMNS) == rows(batch, *COLUMNS)


@pytest.mark.parametrize("terms", [1, 129, 20_000, 200_000])
def test_stream_has_no_bound_of_terms(spark, edge_documents, tmp_path, terms):
    fillers = spark.range(terms - 1).selectExpr("concat('t', id) AS token", "-1L AS weight")
    lexicon = scoring.lexicon_table(spark, {"profit": 1}).union(fillers)
    stream = score_stream(arriving(spark, edge_documents, tmp_path / "in", 2), lexicon)
    out = str(tmp_path / "out")
    stream.writeStream.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "state")).start(out, "parquet").awaitTermination()
    batch = docs_ops.clean_documents(edge_documents).transform(scoring.score_documents(lexicon))
    assert rows(spark.read.parquet(out), *COLUMNS) == rows(batch, *COLUMNS)


def test_partials_survive_restarts(spark, edge_documents, edge_lexicon, tmp_path):
    stream = arriving(spark, edge_documents, tmp_path / "in", 4)
    out, state = str(tmp_path / "partials"), str(tmp_path / "state")
    for _ in range(2):
        writer = partials_writer(stream, edge_lexicon, out, state)
        writer.trigger(availableNow=True).start().awaitTermination()
    batch = docs_ops.clean_documents(edge_documents).transform(scoring.score_documents(edge_lexicon))
    partials = load_partials(spark, out, "parquet")
    assert partials.agg(F.sum("documents")).first()[0] == 11
    assert summaries.merge_partials(partials).first() == summaries.summarize(batch).first()


def test_stream_with_a_large_lexicon(spark, edge_documents, tmp_path):
    lexicon = scoring.lexicon_table(spark, {"profit": 1, **{f"t{i}": -1 for i in range(20_000)}})
    out = str(tmp_path / "scored")
    writer = scored_writer(arriving(spark, edge_documents, tmp_path / "in", 2), lexicon, out, str(tmp_path / "state"))
    writer.trigger(availableNow=True).start().awaitTermination()
    batch = docs_ops.clean_documents(edge_documents).transform(scoring.score_documents(lexicon))
    assert rows(spark.read.parquet(out), *COLUMNS) == rows(batch, *COLUMNS)
