"""The registered queries; each takes a session and a table folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonescale.functions.text import strip
from tonescale.operators import documents as docs_ops
from tonescale.operators import evaluation, numbering, reconcile, scoring, summaries
from tonescale.operators import vocabulary as words
from tonescale.plans import inputs, stored
from tonescale.runtime import scratch_path, write_once
from tonescale.schemas import CLASSES
from tonescale.sinks import writers
from tonescale.sources.documents import load_documents
from tonescale.sources.records import load_partials, load_predictions, load_token_records
from tonescale.streaming.scoring import partials_writer

Query = Callable[[SparkSession, str], DataFrame]

CHUNK_SIZE = 100
SCORES = ("doc_id", "score", "positive_hits", "negative_hits", "predicted_sentiment")
COUNTS = ("documents", "positive", "negative", "neutral")


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs_ops.prepare_documents(inputs.documents(spark, sf_dir))


def _scored(spark: SparkSession, sf_dir: str, *carry: str) -> DataFrame:
    docs = inputs.documents(spark, sf_dir, *carry)
    return scoring.score_corpus(docs, inputs.test_lexicon(spark), carry=carry)


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.attach_labels(_scored(spark, sf_dir), inputs.labels(spark, sf_dir))


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.evaluation_counts(evaluation.validate_predictions(_judged(spark, sf_dir)))


# --- documents ----------------------------------------------------------------


def dedup_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Lengths are functions of the text, so no text is shuffled.
    docs = docs_ops.drop_blank(docs_ops.fill_missing_text(inputs.documents(spark, sf_dir)))
    keyed = docs.select(
        "doc_id",
        docs_ops.text_key(F.col("text")).alias("text_key"),
        F.length("text").cast("bigint").alias("n_chars"),
    )
    return docs_ops.first_copies(keyed, ["n_chars"])


def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prepared(spark, sf_dir).select("doc_id", "cleaned_text")


def tokenize_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prepared(spark, sf_dir).select(
        "doc_id",
        F.col("token_count").cast("bigint").alias("token_count"),
        F.array_join("tokens", " ").alias("tokens_joined"),
    )


def preprocess_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs_ops.preprocess_counters(inputs.documents(spark, sf_dir))


def preview_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs_ops.preview_documents(inputs.documents(spark, sf_dir)).select("doc_id", "cleaned_text")


def numbered_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = inputs.turns(spark, sf_dir).select("conv_id", "turn", "role")
    numbered = numbering.with_positions(keys, ["conv_id", "turn"])
    return numbered.select("conv_id", "turn", "role", (F.col("position") + 1).alias("doc_id"))


# --- vocabulary ---------------------------------------------------------------


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.vocabulary(_prepared(spark, sf_dir))


def ranked_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.ranked_vocabulary(_prepared(spark, sf_dir))


def top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.top_words(_prepared(spark, sf_dir))


def corpus_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.corpus_summary(_prepared(spark, sf_dir))


# --- lexicon and scores -------------------------------------------------------


def lexicon_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every term of the parsed lexicon with its corpus frequency."""
    lexicon = inputs.parsed_lexicon(spark)
    found = scoring.lexicon_hits(_prepared(spark, sf_dir), lexicon).select("token", "hits")
    frequency = F.coalesce("hits", F.lit(0).cast("bigint")).alias("frequency")
    return lexicon.join(found, "token", "left").select("token", "weight", frequency)


def lexicon_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.lexicon_hits(_prepared(spark, sf_dir), inputs.test_lexicon(spark))


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select(*SCORES)


def scored_documents_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.documents(spark, sf_dir)
    scored = scoring.score_corpus(docs, inputs.test_lexicon(spark), form="broadcast")
    return scored.select(*SCORES)


def scored_documents_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The form without join for lexicons of many terms, with a corpus-sized lexicon."""
    lexicon = write_once(inputs.vocabulary_lexicon(_prepared(spark, sf_dir)), "lexicon")
    scored = scoring.score_corpus(inputs.documents(spark, sf_dir), lexicon, form="bucketed")
    return scored.select(*SCORES)


def scored_documents_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The form for lexicons beyond broadcasting, with a corpus-sized lexicon."""
    lexicon = write_once(inputs.vocabulary_lexicon(_prepared(spark, sf_dir)), "lexicon")
    scored = scoring.score_corpus(inputs.documents(spark, sf_dir), lexicon, form="shuffled")
    return scored.select(*SCORES)


def mapper_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-document predictions written as JSON and read back."""
    labeled = summaries.attach_labels(_prepared(spark, sf_dir), inputs.labels(spark, sf_dir))
    scored = labeled.transform(scoring.score_documents(inputs.test_lexicon(spark), fold=False))
    path = scratch_path(spark, "mapper-results")
    writers.write_mapper_results(scored, path)
    read = load_predictions(spark, path, "jsonl")
    return read.select(
        "doc_id",
        F.size("tokens").cast("bigint").alias("token_count"),
        "score",
        "predicted_sentiment",
        "true_label",
    )


# --- summaries ----------------------------------------------------------------


def sentiment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.sentiment_summary(_judged(spark, sf_dir), inputs.test_lexicon(spark))


def reducer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.reducer_summary(_judged(spark, sf_dir))


def reducer_summary_any_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels outside the three classes count as evaluated: unlabeled is 'Unrated'."""
    rated = _judged(spark, sf_dir).withColumn("label", F.coalesce("label", F.lit("Unrated")))
    return summaries.reducer_summary(rated)


def _chunk_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunked = numbering.assign_chunks(_judged(spark, sf_dir), CHUNK_SIZE)
    return summaries.partial_summary(chunked, "chunk_id")


def chunk_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunk_partials(spark, sf_dir).select("chunk_id", *COUNTS)


def merged_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "chunk-partials")
    writers.write_partials(_chunk_partials(spark, sf_dir), path, "parquet")
    return summaries.merge_partials(load_partials(spark, path, "parquet"))


def sentiment_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_lang = summaries.partial_summary(_scored(spark, sf_dir, "lang"), "lang")
    return by_lang.select("lang", *COUNTS)


def sentiment_by_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as a corpus; their ids are positions by (conv_id, turn)."""
    numbered = numbered_turns(spark, sf_dir).select("conv_id", "turn", "doc_id")
    texts = inputs.turns(spark, sf_dir).select("conv_id", "turn", "role", "text")
    docs = texts.join(numbered, ["conv_id", "turn"])
    scored = scoring.score_corpus(docs, inputs.test_lexicon(spark), carry=["role"])
    return summaries.partial_summary(scored, "role").select("role", *COUNTS)


def streamed_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, copies included, scored as a stream of partial counts."""
    reader = spark.readStream.schema("doc_id bigint, text string")
    # A pattern, because a stream takes a plain path for a folder.
    stream = reader.parquet(f"{sf_dir}/documents.parquet*")
    out, state = scratch_path(spark, "partials"), scratch_path(spark, "stream-state")
    writer = partials_writer(stream, inputs.test_lexicon(spark), out, state)
    writer.trigger(availableNow=True).start().awaitTermination()
    return summaries.merge_partials(load_partials(spark, out, "parquet"))


# --- comparison and evaluation ------------------------------------------------


def reconcile_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    revised = scoring.score_corpus(inputs.documents(spark, sf_dir), inputs.revised_lexicon(spark))
    return reconcile.reconcile(_scored(spark, sf_dir), revised)


def reconcile_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literal against broadcast form: no differences."""
    return reconcile.reconcile(_scored(spark, sf_dir), scored_documents_join(spark, sf_dir))


def validated_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    validated = evaluation.validate_predictions(_judged(spark, sf_dir))
    return validated.select(
        "doc_id", "predicted_sentiment", "score", "token_count", "true_label", "is_correct"
    )


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.confusion_matrix(_counts(spark, sf_dir))


def class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.class_metrics(_counts(spark, sf_dir))


def metrics_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.metrics_summary(_counts(spark, sf_dir))


# --- sources and sinks --------------------------------------------------------


def _labeled_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.attach_labels(inputs.documents(spark, sf_dir), inputs.labels(spark, sf_dir))


def csv_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label and text through CSV in id order; ids are given again by file order."""
    path = scratch_path(spark, "csv")
    ordered = _labeled_texts(spark, sf_dir).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    writers.write_csv(ordered.select("label", "text"), path, header=False, encoding="UTF-8")
    return numbering.assign_doc_ids(load_documents(spark, path, "csv", encoding="UTF-8", located=True))


def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files holding a JSON list of records each."""
    path = scratch_path(spark, "json")
    stored.write_json_lists(_labeled_texts(spark, sf_dir), path, ["doc_id", "label", "text"], "text")
    schema = "doc_id bigint, label string, text string"
    return load_documents(spark, path, "json", schema=schema).select("doc_id", "label", "text")


def json_column_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files holding one object of equally long columns each."""
    path = scratch_path(spark, "json-columns")
    columns = ("doc_id", "label", "text")
    # Lists of structs keep the NULL labels that lists of labels would drop.
    grouped = (
        stored.json_parts(_labeled_texts(spark, sf_dir), "text")
        .groupBy("part")
        .agg(F.collect_list(F.struct(*columns)).alias("records"))
    )
    arrays = F.struct(*[F.col(f"records.{name}").alias(name) for name in columns])
    objects = grouped.select("part", F.to_json(arrays).alias("value"))
    objects.write.partitionBy("part").text(path)
    return load_documents(spark, path, "json").drop("part")


def jsonl_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "jsonl")
    writers.write_scored(_labeled_texts(spark, sf_dir), path)
    schema = "doc_id bigint, label string, text string"
    return load_documents(spark, path, "jsonl", schema=schema)


def text_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of all texts as documents, with their number of occurrences."""
    path = scratch_path(spark, "txt")
    inputs.documents(spark, sf_dir).select("text").write.text(path)
    lines = load_documents(spark, path, "txt")
    return lines.groupBy("text").agg(F.count(F.lit(1)).alias("lines"))


def token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-records")
    labeled = summaries.attach_labels(_prepared(spark, sf_dir), inputs.labels(spark, sf_dir))
    writers.write_token_records(labeled, path)
    read = load_token_records(spark, path, "jsonl")
    return read.select(
        "doc_id",
        strip(F.col("original_text")).alias("stripped_text"),
        "cleaned_text",
        F.array_join("tokens", " ").alias("tokens_joined"),
        "label",
    )


def cleaned_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "cleaned")
    writers.write_cleaned_csv(_prepared(spark, sf_dir), path)
    schema = "doc_id bigint, text string, cleaned_text string, tokens string, token_count bigint"
    read = spark.read.schema(schema).csv(path, header=True, escape='"', multiLine=True)
    tokens = F.from_json("tokens", "array<string>")
    return read.select(
        "doc_id", "text", F.array_join(tokens, " ").alias("tokens_joined"), "token_count"
    )


def top_words_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "top-words")
    writers.write_top_words(words.ranked_vocabulary(_prepared(spark, sf_dir)), path)
    # Written in frequency order, so file order gives the rank back.
    read = spark.read.schema("token string, frequency bigint").csv(path, header=True, escape='"')
    return numbering.assign_doc_ids(read).withColumnRenamed("doc_id", "rank")


def _read_back_json(spark: SparkSession, frame: DataFrame, name: str) -> DataFrame:
    """A summary written as JSON and read with its own schema."""
    path = scratch_path(spark, name)
    writers.write_summary(frame, path)
    return spark.read.schema(frame.schema).json(path, mode="FAILFAST")


def corpus_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written corpus summary; the top words as one text."""
    prepared = _prepared(spark, sf_dir).select("doc_id", "tokens").persist()
    report = words.corpus_report(prepared, f"{sf_dir}/documents.parquet")
    read = _read_back_json(spark, report, "corpus-report")
    prepared.unpersist()
    listed = F.transform("top_20_words", lambda w: F.concat_ws(":", w["token"], w["frequency"]))
    return read.select(
        "text_column",
        "documents_count",
        "total_tokens",
        "unique_tokens",
        "avg_tokens_per_document",
        F.array_join(listed, " ").alias("top_20_words"),
    )


def metrics_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written evaluation report, its nested parts as columns."""
    read = _read_back_json(spark, evaluation.metrics_report(_counts(spark, sf_dir)), "metrics-report")
    measures = ("precision", "recall", "f1", "support")
    return read.select(
        "documents_count",
        "accuracy",
        "avg_score",
        *[
            F.col("class_metrics")[name][measure].alias(f"{name}_{measure}")
            for name in CLASSES
            for measure in measures
        ],
        *[
            F.col("confusion_matrix")[true][predicted].alias(f"{true}_as_{predicted}")
            for true in CLASSES
            for predicted in CLASSES
        ],
    )


def scored_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored documents with tokens, written as JSON lines and read back."""
    scored = _prepared(spark, sf_dir).transform(
        scoring.score_documents(inputs.test_lexicon(spark), fold=False)
    )
    path = scratch_path(spark, "scored")
    writers.write_scored(scored.select(*SCORES, "tokens"), path)
    read = load_predictions(spark, path, "jsonl")
    return read.select(*SCORES, F.array_join("tokens", " ").alias("tokens_joined"))


def validated_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated predictions written as Parquet, read back and evaluated."""
    path = scratch_path(spark, "validated")
    writers.write_scored(validated_predictions(spark, sf_dir), path, "parquet")
    validated = evaluation.validate_predictions(load_predictions(spark, path, "parquet"))
    return evaluation.metrics_summary(evaluation.evaluation_counts(validated))


def parquet_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet documents whose text column is found by its name."""
    path = scratch_path(spark, "parquet")
    _labeled_texts(spark, sf_dir).withColumnRenamed("text", "Body").write.parquet(path)
    return load_documents(spark, path, "parquet").select("doc_id", "label", "text")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        sentiment_summary,
        dedup_documents,
        clean_documents,
        tokenize_documents,
        preprocess_counters,
        preview_documents,
        numbered_turns,
        vocabulary,
        ranked_vocabulary,
        top_words,
        corpus_summary,
        lexicon_terms,
        lexicon_hits,
        scored_documents,
        scored_documents_join,
        scored_documents_bucketed,
        scored_documents_shuffled,
        mapper_results,
        reducer_summary,
        reducer_summary_any_label,
        chunk_summary,
        merged_summary,
        sentiment_by_lang,
        sentiment_by_role,
        streamed_summary,
        reconcile_scores,
        reconcile_forms,
        validated_predictions,
        confusion_matrix,
        class_metrics,
        metrics_summary,
        csv_documents,
        json_documents,
        jsonl_documents,
        text_documents,
        token_records,
        cleaned_dataset,
        top_words_csv,
        corpus_report,
        metrics_report,
        scored_records,
        validated_records,
        json_column_documents,
        parquet_documents,
    )
} | stored.QUERIES
