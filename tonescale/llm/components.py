"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonescale.runtime import write_once


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(pairs: DataFrame) -> DataFrame:
    """Every neighbour b of a, with the least of a and its neighbours."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return pairs.join(least, "a")


def connected(links: DataFrame) -> DataFrame:
    """node, label: the least node reachable; only nodes that have links.

    Each round hangs larger neighbours, then smaller ones, on the least known
    node; the number of rounds grows with the logarithm of the longest chain.
    Links and labels stay in written tables.
    """
    edges = write_once(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().filter("a < b"), "links")
    while True:
        large = _star(_both_ways(edges)).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.filter("b < a").distinct()
        small = _star(down)
        hung = small.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = small.select("a", F.col("m").alias("b"))
        stars = write_once(hung.union(own).filter("b < a").distinct().select(F.col("b").alias("a"), F.col("a").alias("b")), "stars")
        changed = stars.join(edges, ["a", "b"], "left_anti").limit(1).count() or edges.join(stars, ["a", "b"], "left_anti").limit(1).count()
        edges = stars
        if not changed:
            break
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("label")).union(roots)
