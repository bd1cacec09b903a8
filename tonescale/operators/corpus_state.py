"""The state of a corpus that arrives in batches: counts that merge.

Every batch stores what its documents add: words with their frequency and first
occurrence, and totals.  Storing a batch again replaces what it stored before and
leaves the other batches as they are, so a batch can be corrected, or redone after
a failure, without reading the corpus again.  Reading adds the batches up.

Documents must be prepared, and a text belong to one batch only, as it does when
copies are removed before the corpus is cut into batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonescale.functions.ratios import ratio
from tonescale.operators.summaries import PARTIAL_COLUMNS, merge_partials, partial_summary
from tonescale.operators.vocabulary import POSITIONS, ranked_vocabulary

WORDS = "token string, frequency bigint, first_doc bigint, first_pos bigint, batch bigint"
TOTALS = "documents bigint, tokens bigint, batch bigint"
PARTIALS = ", ".join(f"{name} bigint" for name in (*PARTIAL_COLUMNS, "batch"))


def _replace(frame: DataFrame, path: str, batch: int) -> None:
    """Store the rows of a batch in place of its earlier ones; other batches are not touched.

    A batch without rows takes its earlier ones away: its folder is written by itself.
    """
    frame.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def store_batch(prepared: DataFrame, path: str, batch: int) -> None:
    """Store the words and totals of a batch of prepared documents (doc_id, tokens) below ``path``."""
    _replace(ranked_vocabulary(prepared), f"{path}/words", batch)
    totals = prepared.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum(F.size("tokens")), F.lit(0)).cast("bigint").alias("tokens"))
    _replace(totals, f"{path}/totals", batch)


def store_scores(scored: DataFrame, path: str, batch: int) -> None:
    """Store the sentiment counts of a batch of scored documents below ``path``."""
    counts = partial_summary(scored.withColumn("_all", F.lit(0)), "_all").drop("_all")
    _replace(counts, f"{path}/partials", batch)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def stored_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """``ranked_vocabulary`` of all stored batches: frequencies add up, the earliest occurrence counts.

    One row per batch and token is shuffled, not one per occurrence.
    """
    positions = F.lit(POSITIONS).cast("decimal(10,0)")
    seen = F.col("first_doc").cast("decimal(20,0)") * positions + F.col("first_pos").cast("decimal(10,0)")
    merged = _read(spark, f"{path}/words", WORDS).groupBy("token").agg(
        F.sum("frequency").alias("frequency"), F.min(seen).alias("first_seen")
    )
    return merged.withColumn("first_pos", F.pmod("first_seen", positions)).select(
        "token",
        "frequency",
        F.expr(f"(first_seen - first_pos) div {POSITIONS}").alias("first_doc"),
        F.col("first_pos").cast("bigint").alias("first_pos"),
    )


def stored_summary(spark: SparkSession, path: str) -> DataFrame:
    """Corpus totals of all stored batches."""
    zero = F.lit(0).cast("bigint")
    totals = _read(spark, f"{path}/totals", TOTALS).agg(
        F.coalesce(F.sum("documents"), zero).alias("documents_count"), F.coalesce(F.sum("tokens"), zero).alias("total_tokens")
    )
    unique = _read(spark, f"{path}/words", WORDS).select("token").distinct().agg(F.count(F.lit(1)).alias("n"))
    average = F.coalesce(ratio(F.col("total_tokens"), F.col("documents_count"), 2), F.lit(0.0))
    return totals.select("*", unique.scalar().alias("unique_tokens"), average.alias("avg_tokens_per_document"))


def stored_sentiment(spark: SparkSession, path: str) -> DataFrame:
    """Sentiment summary of all stored batches."""
    return merge_partials(_read(spark, f"{path}/partials", PARTIALS))
