"""Term frequencies, ranked words and corpus totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tokens are exploded with the outer generators throughout.  From a plain
# explode Catalyst infers the filter size(tokens) > 0 and pushes it to the
# scan, where it would clean and split every text a second time.


def vocabulary(prepared: DataFrame) -> DataFrame:
    """Frequency of every token; counted per task before the shuffle."""
    return (
        prepared.select(F.explode_outer("tokens").alias("token"))
        .filter(F.col("token").isNotNull())
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("frequency"))
    )


# Positions fit below this, so doc_id * POSITIONS + position orders occurrences.
POSITIONS = 2**31


def ranked_vocabulary(prepared: DataFrame) -> DataFrame:
    """Vocabulary with ``first_doc`` and ``first_pos``, where a token first occurs.

    The occurrence is one exact decimal.  Its minimum has a fixed-size buffer,
    so counting stays a hash aggregate; the minimum of a (document, position)
    struct would sort all tokens.
    """
    ids = F.col("doc_id").cast("decimal(20,0)") * F.lit(POSITIONS).cast("decimal(10,0)")
    tokens = prepared.select(
        ids.alias("before"), F.posexplode_outer("tokens").alias("pos", "token")
    ).filter(F.col("token").isNotNull())
    counts = tokens.groupBy("token").agg(
        F.count(F.lit(1)).alias("frequency"),
        F.min(F.col("before") + F.col("pos").cast("decimal(10,0)")).alias("first_seen"),
    )
    first_pos = F.pmod("first_seen", F.lit(POSITIONS).cast("decimal(10,0)"))
    return counts.withColumn("first_pos", first_pos).select(
        "token",
        "frequency",
        F.expr(f"(first_seen - first_pos) div {POSITIONS}").alias("first_doc"),
        F.col("first_pos").cast("bigint").alias("first_pos"),
    )


def frequency_order() -> list:
    """Most frequent first; equal frequencies by first occurrence in the corpus."""
    return [F.desc("frequency"), F.asc("first_doc"), F.asc("first_pos")]


def top_words(prepared: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` most frequent words with their rank.

    The ranks are positions in an array of at most ``k`` words.
    """
    best = ranked_vocabulary(prepared).orderBy(*frequency_order()).limit(k)
    return _top_array(best).select(F.posexplode("top_words").alias("pos", "word")).select(
        (F.col("pos") + 1).cast("bigint").alias("rank"), "word.token", "word.frequency"
    )


def _top_array(best: DataFrame) -> DataFrame:
    order = F.struct(
        (-F.col("frequency")).alias("less"), "first_doc", "first_pos", "token", "frequency"
    )
    words = F.array_sort(F.collect_list(order))
    return best.agg(
        F.transform(words, lambda w: F.struct(w["token"], w["frequency"])).alias("top_words")
    )


def corpus_summary(prepared: DataFrame) -> DataFrame:
    """Documents, total and unique tokens, mean tokens per document.

    Every document also emits one NULL token, so the vocabulary aggregate
    counts documents and tokens in the same pass.
    """
    counts = (
        prepared.select(F.explode_outer(F.array_append("tokens", F.lit(None))).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("frequency"))
    )
    token, frequency = F.col("token"), F.col("frequency")
    zero = F.lit(0).cast("bigint")
    totals = counts.agg(
        F.coalesce(F.sum(F.when(token.isNull(), frequency)), zero).alias("documents_count"),
        F.coalesce(F.sum(F.when(token.isNotNull(), frequency)), zero).alias("total_tokens"),
        F.count(token).alias("unique_tokens"),
    )
    mean = F.round(F.try_divide(F.col("total_tokens").cast("double"), F.col("documents_count")), 2)
    return totals.withColumn("avg_tokens_per_document", F.coalesce(mean, F.lit(0.0)))


def corpus_report(prepared: DataFrame, input_file: str, text_column: str = "text", k: int = 20) -> DataFrame:
    """One-row corpus summary with its ``top_20_words`` array.

    Reads ``prepared`` twice: persist it or read it from a table.
    """
    best = ranked_vocabulary(prepared).orderBy(*frequency_order()).limit(k)
    both = corpus_summary(prepared).unionByName(_top_array(best), allowMissingColumns=True)
    return both.agg(
        F.lit(input_file).alias("input_file"),
        F.lit(text_column).alias("text_column"),
        *[
            F.max(name).alias(name)
            for name in ("documents_count", "total_tokens", "unique_tokens", "avg_tokens_per_document")
        ],
        F.first("top_words", ignorenulls=True).alias(f"top_{k}_words"),
    )
