"""Tables and lexicons that the registered queries read."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonescale.operators.scoring import lexicon_table
from tonescale.operators.vocabulary import vocabulary
from tonescale.runtime import fill_cores
from tonescale.sources.lexicon import parse_lexicon

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LABELS = "doc_id bigint, quality int, toxic int"
TURNS = "conv_id bigint, turn bigint, role string, text string"

# Test lexicon with weights of both signs, magnitudes 1 and 2,
# and a zero weight, whose words occur in the test tables.
TEST_LEXICON = {
    "best": 1,
    "that": 1,
    "que": 1,
    "und": 1,
    "which": 1,
    "the": 0,
    "with": -1,
    "les": -1,
    "von": -1,
    "worthless": -1,
    "stupid": -1,
    "trash": -1,
    "clown": -1,
    "idiot": -2,
    "moron": -2,
}

# A second version: no double weights, one word turned, one dropped.
REVISED_LEXICON = {
    **{word: max(-1, min(1, weight)) for word, weight in TEST_LEXICON.items() if word != "von"},
    "which": -1,
}

# The test lexicon as a lexicon file: blocks, mixed case and a repeated word.
LEXICON_JSON = json.dumps(
    {
        "positive": {"Best": -7, "That": 1, "que": 1, "und": 1, "which": 1},
        "zero": {"the": 0},
        "negative": {w: v for w, v in TEST_LEXICON.items() if v < 0},
        "corrected": {"best": 1},
    }
)


def documents(spark: SparkSession, sf_dir: str, *carry: str) -> DataFrame:
    """The corpus: id, text and the named further columns."""
    table = spark.read.schema(DOCUMENTS).parquet(f"{sf_dir}/documents.parquet")
    return fill_cores(table.select("doc_id", "text", *carry), "doc_id")


def gappy_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus with gaps: every fifth text is missing, every tenth its first blanks, every tenth its first punctuation."""
    gap = (
        F.when(F.col("doc_id") % 5 == 0, F.lit(None).cast("string"))
        .when(F.col("doc_id") % 10 == 1, F.regexp_extract("text", r"[ \t\r\n]+", 0))
        .when(F.col("doc_id") % 10 == 6, F.regexp_extract("text", r"[!-/:-@]+", 0))
        .otherwise(F.col("text"))
    )
    return documents(spark, sf_dir).withColumn("text", gap)


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True sentiment of the labeled documents."""
    label = (
        F.when(F.col("toxic") == 1, "negative")
        .when(F.col("quality") == 1, "positive")
        .when(F.col("quality") == 0, "neutral")
    )
    table = spark.read.schema(LABELS).parquet(f"{sf_dir}/labels.parquet")
    return table.select("doc_id", label.alias("label"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(TURNS).parquet(f"{sf_dir}/conversations.parquet")


def test_lexicon(spark: SparkSession) -> DataFrame:
    return lexicon_table(spark, TEST_LEXICON)


def revised_lexicon(spark: SparkSession) -> DataFrame:
    return lexicon_table(spark, REVISED_LEXICON)


def parsed_lexicon(spark: SparkSession) -> DataFrame:
    return parse_lexicon(spark.range(1).select(F.lit(LEXICON_JSON).alias("value")))


def vocabulary_lexicon(prepared: DataFrame) -> DataFrame:
    """A lexicon that grows with the corpus: every word weighted by its length."""
    weight = (F.length("token") % 5 - 2).cast("bigint")
    return vocabulary(prepared).select("token", weight.alias("weight"))
