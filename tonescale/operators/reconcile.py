"""Comparison of two scorings of the same documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _one_per_document(scored: DataFrame, side: str, order: str | None) -> DataFrame:
    """One row per id: the last by ``order``, or an error on repeated ids.

    The grouping shares its partitioning with the join that follows.
    """
    groups = scored.groupBy("doc_id")
    if order is not None:
        score, label = F.max_by("score", order), F.max_by("predicted_sentiment", order)
    else:
        message = F.concat(F.lit(f"doc_id repeated on the {side} side: "), F.coalesce(F.col("doc_id").cast("string"), F.lit("NULL")))
        repeated = F.count(F.lit(1)) > 1
        score = F.when(repeated, F.raise_error(message).cast("bigint")).otherwise(F.max("score"))
        label = F.max("predicted_sentiment")
    return groups.agg(score.alias(f"{side}_score"), label.alias(f"{side}_label")).withColumn(
        f"_in_{side}", F.lit(True)
    )


def reconcile(left: DataFrame, right: DataFrame, order: str | None = None) -> DataFrame:
    """Documents whose score or label differs, or that one side lacks.

    Empty means the scorings agree.
    """
    pairs = _one_per_document(left, "left", order).join(
        _one_per_document(right, "right", order), "doc_id", "full_outer"
    )
    same = (
        F.col("_in_left").eqNullSafe(F.col("_in_right"))
        & F.col("left_score").eqNullSafe(F.col("right_score"))
        & F.col("left_label").eqNullSafe(F.col("right_label"))
    )
    return pairs.filter(~same).drop("_in_left", "_in_right")


# Buckets of ids whose checksums are compared first; the differing ones are broadcast, so this bounds them.
BUCKETS = 1 << 16


def _bucket() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).alias("_bucket")


def _checksums(scored: DataFrame, side: str) -> DataFrame:
    """Per bucket, whatever the order of the rows: their number and the sums of two digests of each."""
    # A NULL adds nothing to a hash, so each is marked.
    marks = [c for name in ("doc_id", "score", "predicted_sentiment") for c in (F.col(name), F.col(name).isNull())]
    sums = [F.sum(F.xxhash64(F.lit(seed), *marks).cast("decimal(20,0)")) for seed in (1, 2)]
    counted = scored.groupBy(_bucket()).agg(F.count(F.lit(1)).alias("n"), *[s.alias(f"s{i}") for i, s in enumerate(sums)])
    return counted.select("_bucket", *[F.col(name).alias(f"{side}_{name}") for name in ("n", "s0", "s1")])


def differing_buckets(left: DataFrame, right: DataFrame) -> DataFrame:
    """``_bucket``: the buckets of ids whose rows are not the same on both sides; at most ``BUCKETS`` rows."""
    pairs = _checksums(left, "left").join(_checksums(right, "right"), "_bucket", "full_outer")
    same = F.lit(True)
    for name in ("n", "s0", "s1"):
        same = same & F.col(f"left_{name}").eqNullSafe(F.col(f"right_{name}"))
    return pairs.filter(~same).select("_bucket")


def reconcile_by_digest(left: DataFrame, right: DataFrame, order: str | None = None) -> DataFrame:
    """As ``reconcile`` for stored scorings that mostly agree.

    Each side is summed up by buckets of ids in its tasks, so only checksums are
    shuffled; rows are joined in the buckets whose checksums differ.  Both sides
    are read twice, so hand over tables.  Ids that are repeated in the same way on
    both sides are not noticed in a bucket that agrees.
    """
    differing = F.broadcast(differing_buckets(left, right))
    rest = [side.withColumn("_bucket", _bucket()).join(differing, "_bucket", "left_semi").drop("_bucket") for side in (left, right)]
    return reconcile(*rest, order)
