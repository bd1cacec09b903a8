"""Registered queries over stored records, files of every kind, and texts with gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonescale.operators import documents as docs_ops
from tonescale.operators import corpus_state, evaluation, numbering, reconcile, scoring, summaries
from tonescale.operators import vocabulary as words
from tonescale.plans import inputs
from tonescale.runtime import scratch_path, write_once
from tonescale.sinks import writers
from tonescale.sources.documents import load_documents
from tonescale.sources.lexicon import load_lexicon
from tonescale.sources.records import load_predictions, load_token_records

CHUNK_SIZE = 100
# A JSON list or object is read by one task, in memory.
JSON_FILE_BYTES = 32 * 1024 * 1024
# Bytes of a record's ids, names and marks beside its text.
RECORD_BYTES = 128
SCORES = ("doc_id", "score", "positive_hits", "negative_hits", "predicted_sentiment")


def json_parts(frame: DataFrame, *sized: str) -> DataFrame:
    """Records with a file number, so that no JSON file gets much larger than the bound.

    ``sized`` are the columns that make up a record's size.  Ids are spread by hash.
    """
    record = sum((F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) for name in sized), F.lit(RECORD_BYTES).cast("bigint"))
    size = frame.agg(F.sum(record)).first()[0] or 0
    return frame.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(size // JSON_FILE_BYTES + 1)))


def write_json_lists(frame: DataFrame, path: str, columns: list[str], *sized: str) -> None:
    """Files that hold a JSON list of records each."""
    records = F.collect_list(F.struct(*columns))
    lists = json_parts(frame, *sized).groupBy("part").agg(F.to_json(records).alias("value"))
    lists.write.partitionBy("part").text(path)


# --- texts with gaps ------------------------------------------------------------


def gappy_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of a corpus with missing, blank and punctuation-only texts."""
    return docs_ops.preprocess_counters(inputs.gappy_documents(spark, sf_dir))


def gappy_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing texts are the word ``nan``, blank and empty ones leave."""
    prepared = docs_ops.prepare_documents(inputs.gappy_documents(spark, sf_dir))
    return prepared.select("doc_id", "cleaned_text", F.col("token_count").cast("bigint").alias("token_count"))


def gappy_documents_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``gappy_documents`` with missing texts left out; scored without words of their own."""
    docs = inputs.gappy_documents(spark, sf_dir)
    return scoring.score_corpus(docs, inputs.test_lexicon(spark), null_policy="drop").select(*SCORES)


# --- stored records ---------------------------------------------------------------


def _odd_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token records as another tool may leave them: words in upper case, no id, no tokens."""
    prepared = docs_ops.prepare_documents(inputs.documents(spark, sf_dir)).withColumnRenamed("text", "original_text")
    raised = F.transform("tokens", lambda t: F.when(t.rlike("^[a-z]+$"), F.upper(t)).otherwise(t))
    doc_id = F.col("doc_id")
    return prepared.select(
        F.when(doc_id % 7 != 0, doc_id).alias("doc_id"),
        F.when(doc_id % 11 != 0, F.when(doc_id % 3 == 0, raised).otherwise(F.col("tokens"))).alias("tokens"),
    )


def _scored_records(spark: SparkSession, records: DataFrame) -> DataFrame:
    scored = records.transform(scoring.score_documents(inputs.test_lexicon(spark)))
    return scored.select(*SCORES, F.size("tokens").cast("bigint").alias("token_count"))


def stored_record_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored token records, read, folded, given defaults and scored."""
    path = scratch_path(spark, "odd-records")
    writers.write_scored(_odd_records(spark, sf_dir), path)
    return _scored_records(spark, load_token_records(spark, path, "jsonl"))


def listed_record_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from files that hold a list of records each, summed up."""
    path = scratch_path(spark, "listed-records")
    write_json_lists(_odd_records(spark, sf_dir), path, ["doc_id", "tokens"], "tokens")
    return summaries.summarize(_scored_records(spark, load_token_records(spark, path)))


def listed_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions from JSON lists: the class is in ``predicted`` where ``predicted_sentiment`` holds none."""
    scored = scoring.score_corpus(inputs.documents(spark, sf_dir), inputs.test_lexicon(spark))
    judged = summaries.attach_labels(scored, inputs.labels(spark, sf_dir))
    found = F.col("predicted_sentiment")
    named = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(" "), F.upper(found))).when(F.col("doc_id") % 3 == 1, F.lit("unsure"))
    other = F.when(F.col("doc_id") % 3 != 0, found).otherwise(F.lit("neutral"))
    records = judged.select("doc_id", "score", "token_count", "label", named.alias("predicted_sentiment"), other.alias("predicted"))
    path = scratch_path(spark, "listed-predictions")
    write_json_lists(records, path, records.columns)
    validated = evaluation.validate_predictions(load_predictions(spark, path))
    return validated.select("doc_id", "predicted_sentiment", "score", "token_count", "true_label", "is_correct")


def lexicon_file_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary by a lexicon read from its file."""
    path = scratch_path(spark, "lexicon-file")
    spark.range(1).select(F.lit(inputs.LEXICON_JSON).alias("value")).write.text(path)
    # Spark leaves an empty file for each task without rows; the lexicon is the one that is not.
    lexicon = load_lexicon(spark, f"{path}/part-*")
    scored = scoring.score_corpus(inputs.documents(spark, sf_dir), lexicon)
    return summaries.sentiment_summary(summaries.attach_labels(scored, inputs.labels(spark, sf_dir)), lexicon)


# --- files ------------------------------------------------------------------------


def suffix_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose format is told by the path's suffix, in any case."""
    path = scratch_path(spark, "suffix") + ".JSONL"
    docs = inputs.documents(spark, sf_dir).select("doc_id", F.col("text").alias("Review"))
    writers.write_scored(docs, path)
    return load_documents(spark, path).select("doc_id", "text")


def vocabulary_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written vocabulary; files are in frequency order, so file order gives the rank back."""
    path = scratch_path(spark, "vocabulary")
    ranked = words.ranked_vocabulary(docs_ops.prepare_documents(inputs.documents(spark, sf_dir)))
    writers.write_vocabulary(ranked, path)
    read = spark.read.schema("token string, frequency bigint").json(path, mode="FAILFAST")
    return numbering.assign_doc_ids(read).withColumnRenamed("doc_id", "rank")


def reducer_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written reducer summaries, of labeled and of unlabeled documents: the latter names no accuracy."""
    scored = scoring.score_corpus(inputs.documents(spark, sf_dir), inputs.test_lexicon(spark))
    found = []
    for name, frame in (("labeled", summaries.attach_labels(scored, inputs.labels(spark, sf_dir))), ("unlabeled", scored)):
        path = scratch_path(spark, f"reducer-{name}")
        summary = summaries.reducer_summary(frame)
        writers.write_summary(summary, path, keep_nulls=False)
        parsed = F.from_json("value", summary.schema, {"mode": "FAILFAST"}).alias("row")
        accuracies = F.col("value").contains('"accuracy"').cast("bigint").alias("accuracies")
        found.append(spark.read.text(path).select(F.lit(name).alias("kind"), parsed, accuracies).select("kind", "row.*", "accuracies"))
    return found[0].union(found[1])


def chunk_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored documents with their chunk, written and read back."""
    scored = scoring.score_corpus(inputs.documents(spark, sf_dir), inputs.test_lexicon(spark))
    path = scratch_path(spark, "chunk-documents")
    writers.write_scored(numbering.assign_chunks(scored.select(*SCORES), CHUNK_SIZE), path)
    schema = "doc_id bigint, score bigint, positive_hits bigint, negative_hits bigint, predicted_sentiment string, chunk_id bigint"
    return spark.read.schema(schema).json(path, mode="FAILFAST")


# --- state that grows by batches ----------------------------------------------------


def _stored_batches(spark: SparkSession, sf_dir: str) -> str:
    """Four batches of the corpus; the third is first stored with half of its documents, then again."""
    path = scratch_path(spark, "corpus-state")
    prepared = write_once(docs_ops.prepare_documents(inputs.documents(spark, sf_dir)).select("doc_id", "tokens"), "prepared")
    labels, score = inputs.labels(spark, sf_dir), scoring.score_documents(inputs.test_lexicon(spark), fold=False)
    for batch, part in ((2, "doc_id % 8 = 2"), (0, "doc_id % 4 = 0"), (1, "doc_id % 4 = 1"), (2, "doc_id % 4 = 2"), (3, "doc_id % 4 = 3")):
        docs = prepared.filter(part)
        corpus_state.store_batch(docs, path, batch)
        corpus_state.store_scores(summaries.attach_labels(docs.transform(score), labels), path, batch)
    return path


def batched_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_state.stored_vocabulary(spark, _stored_batches(spark, sf_dir))


def batched_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_state.stored_summary(spark, _stored_batches(spark, sf_dir))


def batched_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_state.stored_sentiment(spark, _stored_batches(spark, sf_dir))


def reconcile_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stored scorings by two lexicons, compared by checksums first."""
    docs, sides = inputs.documents(spark, sf_dir), []
    for name, lexicon in (("left", inputs.test_lexicon(spark)), ("right", inputs.revised_lexicon(spark))):
        sides.append(write_once(scoring.score_corpus(docs, lexicon).select("doc_id", "score", "predicted_sentiment"), name))
    return reconcile.reconcile_by_digest(*sides)


QUERIES = {
    query.__name__: query
    for query in (
        gappy_counters,
        gappy_documents,
        gappy_documents_dropped,
        stored_record_scores,
        listed_record_summary,
        listed_predictions,
        lexicon_file_summary,
        suffix_documents,
        vocabulary_file,
        reducer_reports,
        chunk_documents,
        batched_vocabulary,
        batched_summary,
        batched_sentiment,
        reconcile_stored,
    )
}
