"""The corpus pipeline: stages applied to the documents one after the other."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonescale.llm.bpe import encode_decode
from tonescale.llm.decontaminate import contaminated
from tonescale.llm.jaccard_join import jaccard_components
from tonescale.llm.line_dedup import WHITE, dedup_lines
from tonescale.llm.quality_model import classified, good_labels
from tonescale.runtime import write_once

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
TOKENIZER = "byte_bpe_50k.json"
ROW = "__row"  # no column of documents


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    labels = good_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return classified(docs, labels).filter("accepted").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; those of which no word is left go.

    ``n_chars``, where there is such a column, is counted anew.
    """
    found = dedup_lines(docs)
    emptied = (F.col("n_equal") + F.col("n_near") > 0) & (F.btrim("text", F.lit(WHITE)) == "")
    kept = found.filter(~F.coalesce(emptied, F.lit(False))).select(docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component; documents without words stay.

    Components are those of rows, so one row of each stays even where ids repeat
    or are missing; a row without id stays only where no other of its component has one.
    """
    rows = write_once(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")
    found = jaccard_components(rows.select(F.col(ROW).alias("doc_id"), "text"))
    placed = rows.select(ROW, "doc_id").join(found.select(F.col("doc_id").alias(ROW), "component_id"), ROW)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", ROW))[ROW].alias(ROW)
    kept = placed.groupBy("component_id").agg(first).select(ROW)
    return rows.join(kept, ROW, "left_semi").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contaminated(docs, items).filter(F.size("hits") == 0).select(docs.columns)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    return encode_decode(docs, public_tokenizers.path(TOKENIZER), digests=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("bpe", bpe),
]

# Trained models and similarity components are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_once(stage(spark, docs, sf_dir), name)
    return docs
