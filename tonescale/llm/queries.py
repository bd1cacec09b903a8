"""Queries of the numbered operators; each takes (spark, sf_dir) and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonescale.llm.bpe import encode_decode
from tonescale.llm.decontaminate import contaminated
from tonescale.llm.embedding_dedup import vector_components
from tonescale.llm.filter_audit import filter_audit
from tonescale.llm.hard_negatives import hard_negatives
from tonescale.llm.jaccard_join import jaccard_components
from tonescale.llm.line_dedup import dedup_lines
from tonescale.llm.pii import BASE as PII_KINDS
from tonescale.llm.pii import find_pii
from tonescale.llm.quality_model import classified, good_labels
from tonescale.llm.quality_rules import COUNTS, host_rules
from tonescale.llm.secrets import BASE as SECRET_KINDS
from tonescale.llm.secrets import find_secrets
from tonescale.llm.spans import digest_columns
from tonescale.llm.token_counts import count_tokens
from tonescale.llm.url_filters import url_verdicts

TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the text that stays and the numbers of lines, of equal and of near ones that went."""
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the items that a document holds, and whether there are any."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contaminated(docs, table(spark, sf_dir, "benchmark"))
    items = F.array_join(F.transform("hits", lambda h: h["item_id"].cast("string")), ",")
    return found.select("doc_id", F.size("hits").cast("bigint").alias("n_items"), items.alias("items"), (F.size("hits") > 0).alias("contaminated"))


def quality_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, score and verdict of the classifier."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    found = classified(docs, good_labels(labels))
    return found.select("doc_id", F.round("quality_score", 6).alias("quality_score"), "accepted")


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_columns(find_secrets(table(spark, sf_dir, "documents")), SECRET_KINDS)


def pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_columns(find_pii(table(spark, sf_dir, "documents")), PII_KINDS)


def host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *COUNTS, "base_failed", "kept")


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_verdicts(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "words")


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), digests=True)


def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


def negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh id has its label moved by one."""
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved))


def embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_components(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": token_counts,
    "op2_line_dedup": line_dedup,
    "op3_decontamination": decontamination,
    "op4_secrets": secrets,
    "op5_pii": pii,
    "op6_host_rules": host_quality,
    "op7_bpe_round_trip": bpe_round_trip,
    "op8_quality_classes": quality_classes,
    "op9_url_filters": url_filter,
    "op10_jaccard_join": jaccard_join,
    "op11_filter_audit": audit,
    "op12_hard_negatives": negatives,
    "op13_embedding_dedup": embedding_dedup,
}
