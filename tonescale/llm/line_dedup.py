"""Line dedup by deletion neighbourhoods.

A line goes where an earlier line of the corpus is equal to it or one edit (one
character inserted, deleted or replaced) away.  Earlier means a smaller doc_id,
then a smaller line number; missing ids come last.

1. Equal lines meet by a 128-bit hash; the earliest occurrence stays.
2. Of two lines one edit apart, one half is the same: the first or the last
   floor(l / 2) characters, l being the shorter length.  Only lines that share
   such a half with another go on, each with the half that may differ.
3. These lines emit every variant with one character of that half deleted, and
   themselves, as hashed keys.  Equal variants with the deletion at the same
   place are one replacement apart, a line equal to another's variant is one
   deletion apart.  Each line is paired with the earliest it meets, so the pairs
   are as many as the variants at most.
4. The edit distance of the pairs' texts is verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonescale.llm.batches import bound_batches, pairs
from tonescale.runtime import write_once

#: Shorter lines go only where they are equal: in few characters one edit is another word.
LEAST_CHARS = 16
#: Tables of at most so many rows of a few numbers are broadcast (about 64 MB).
BROADCAST_ROWS = 1_000_000
LAST = (1 << 63) - 1
WHITE = " \t\n\x0b\x0c\r"
VARIANTS = "v bigint, p bigint, doc bigint, line bigint, h bigint, g bigint"


def lines_of(docs: DataFrame) -> DataFrame:
    """whole, doc, line, text of every line that has a word; ``whole`` is a hash of the document's text."""
    row = docs.select(
        *document_key(),
        F.posexplode(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n")).alias("line", "text"),
    )
    return row.withColumn("line", F.col("line").cast("bigint")).filter(F.btrim("text", F.lit(WHITE)) != "")


def document_key() -> tuple[Column, Column]:
    """Rows with equal id and text lose the same lines."""
    return F.xxhash64("text").alias("whole"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("doc")


def hashes() -> tuple[Column, Column]:
    return F.xxhash64("text").alias("h"), F.xxhash64(F.lit(1), "text").alias("g")


def halves() -> Column:
    """Keys of the halves for a partner as long or longer, and for one a character shorter: (key, side)."""

    def key(short: int, side: int) -> Column:
        size = (F.length("text") - short).cast("int")
        half = F.floor(size / 2).cast("int")
        part = F.substring("text", F.lit(1), half) if side == 0 else F.substring("text", F.length("text") - half + 1, half)
        return F.struct(F.xxhash64(F.lit(side), size, part).alias("key"), F.lit(side).alias("side"))

    return F.array(*(key(short, side) for short in (0, 1) for side in (0, 1)))


def small(frame: DataFrame) -> DataFrame:
    """A written table, broadcast if it has few rows."""
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashed keys of a line and of its variants: v (key), p (place of the deletion, -1: none)."""
    for batch in batches:
        out: list[list[np.ndarray]] = [[] for _ in range(6)]
        for h, g, doc, line, side, text in pairs(batch):
            codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
            size = len(codes)
            powers = POWERS.upto(size)
            front = np.concatenate([[np.uint64(0)], np.cumsum(codes * powers[:size], dtype=np.uint64)])
            back = front[-1] - front[1:]
            # without character p, what follows moves one place to the front
            keys = front[:-1] + back * INVERSE
            half = (size - 1) // 2
            places = np.arange(half, size) if side == 0 else np.arange(0, size - half)
            own = np.concatenate([[front[-1]], keys[places]])
            count = len(own)
            columns = (own.view(np.int64), np.concatenate([[-1], places]), *(np.full(count, x, np.int64) for x in (doc, line, h, g)))
            for column, values in zip(out, columns):
                column.append(values)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["v", "p", "doc", "line", "h", "g"])


# An odd base of 64-bit polynomial hashes, and its inverse.
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Powers:
    """Powers of the base from 0 on."""

    def __init__(self):
        self.known = np.ones(1, np.uint64)

    def upto(self, size: int) -> np.ndarray:
        if len(self.known) < size:
            self.known = np.concatenate([[np.uint64(1)], np.cumprod(np.full(2 * size, BASE), dtype=np.uint64)])
        return self.known[:size]


POWERS = Powers()


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (later line, earliest line met) of a partition's variants."""
    held = [[c.to_numpy() for c in batch.columns] for batch in batches]
    if not held:
        return
    v, p, doc, line, h, g = (np.concatenate([x[i] for x in held]) for i in range(6))
    order = np.lexsort((line, doc, p, v))
    v, p, doc, line, h, g = (x[order] for x in (v, p, doc, line, h, g))
    later, first = [], []
    # replacements: the same variant and place; the first of each run is the earliest
    starts = np.flatnonzero(np.r_[True, (v[1:] != v[:-1]) | (p[1:] != p[:-1])])
    head = np.repeat(starts, np.diff(np.r_[starts, len(v)]))
    deleted = (p >= 0) & (np.arange(len(v)) != head)
    later.append(np.flatnonzero(deleted))
    first.append(head[deleted])
    # deletions: the line itself (place -1, sorted first) against every line with that variant
    begins = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
    whole = np.repeat(begins, np.diff(np.r_[begins, len(v)]))
    rows = np.flatnonzero((p[whole] == -1) & (p >= 0))
    before = (doc[rows] < doc[whole[rows]]) | ((doc[rows] == doc[whole[rows]]) & (line[rows] < line[whole[rows]]))
    later += [rows[~before], whole[rows[before]]]
    first += [whole[rows[~before]], rows[before]]
    a, b = np.concatenate(later), np.concatenate(first)
    found = np.unique(np.stack([h[a], g[a], h[b], g[b]]), axis=1) if len(a) else np.empty((4, 0), np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["h", "g", "h2", "g2"])


def near_lines(lines: DataFrame, distinct: DataFrame, least_chars: int) -> DataFrame:
    """h, g of the distinct lines that an earlier line is one edit away from."""
    long = lines.filter(F.length("text") >= least_chars - 1)
    keyed = long.select(*hashes(), F.explode(halves()).alias("half")).select("h", "g", "half.key", "half.side")
    shared = keyed.groupBy("key").agg(F.min("h").alias("x"), F.max("h").alias("y")).filter("x < y").select("key")
    met = keyed.join(small(write_once(shared, "shared-halves")), "key", "left_semi").select("h", "g", "side").distinct()
    sides = write_once(met.join(distinct.select("h", "g", "doc", "line"), ["h", "g"]), "near-lines")
    texts = long.select(*hashes(), "doc", "line", "text").join(small(sides.select("h", "g", "doc", "line").distinct()), ["h", "g", "doc", "line"], "left_semi")
    texts = write_once(texts.groupBy("h", "g").agg(F.first("text").alias("text")), "near-texts")
    emitting = sides.join(texts, ["h", "g"]).select("h", "g", "doc", "line", "side", "text")
    variants = emitting.mapInArrow(_variants, VARIANTS)
    met = variants.repartition("v").mapInArrow(_meet, "h bigint, g bigint, h2 bigint, g2 bigint").distinct()
    other = texts.select(F.col("h").alias("h2"), F.col("g").alias("g2"), F.col("text").alias("other"))
    both = met.join(texts, ["h", "g"]).join(other, ["h2", "g2"])
    apart = F.levenshtein("text", "other", 1)
    enough = (F.length("text") >= least_chars) & (F.length("other") >= least_chars)
    return both.filter(enough & (apart == 1)).select("h", "g").distinct()


def line_decisions(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """whole, doc, line, near: the line occurrences that go, by ``document_key``."""
    bound_batches(docs.sparkSession)
    lines = lines_of(docs)
    occurrences = write_once(lines.select("whole", "doc", "line", *hashes()), "line-hashes")
    # the earliest as one number, so that it is aggregated without sorting
    order = F.col("doc").cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(11,0)") + F.col("line")
    least = F.min(order.cast("decimal(38,0)")).alias("least")
    by_line = occurrences.groupBy("h", "g").agg(least, F.count("*").alias("n"))
    line = F.pmod("least", F.lit(1 << 31).cast("decimal(11,0)"))
    doc = ((F.col("least") - line) / F.lit(1 << 31).cast("decimal(11,0)")).cast("bigint").alias("doc")
    distinct = write_once(by_line.select("h", "g", doc, line.cast("bigint").alias("line"), "n"), "distinct-lines")
    near = near_lines(lines, distinct, least_chars).withColumn("near", F.lit(True))
    known = distinct.withColumnsRenamed({"doc": "doc1", "line": "line1"}).join(near, ["h", "g"], "left")
    known = write_once(known.filter("n > 1 or near").select("h", "g", "doc1", "line1", F.coalesce("near", F.lit(False)).alias("near")), "dropped-lines")
    gone = occurrences.join(small(known), ["h", "g"]).filter("near or doc != doc1 or line != line1")
    return gone.select("whole", "doc", "line", "near").distinct()


def dedup_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """The documents without the lines that repeat earlier ones, with ``n_lines``, ``n_equal`` and ``n_near``.

    One row for each input row; all columns stay, except earlier ones of these
    three names, and ``text`` loses the lines that go.  Lines without a word
    always stay; a missing text stays missing and has no lines.  Rows with equal
    doc_id count as one place: their equal lines of equal number all stay.
    Lines shorter than ``least_chars`` characters go only for an equal one.
    """
    gone = line_decisions(docs, least_chars).groupBy("whole", "doc").agg(
        F.collect_set(F.col("line").cast("int")).alias("gone"),
        F.sum(F.when(F.col("near"), 0).otherwise(1)).alias("n_equal"),
        F.sum(F.when(F.col("near"), 1).otherwise(0)).alias("n_near"),
    )
    kept = docs.drop("n_lines", "n_equal", "n_near")
    whole, doc = document_key()
    placed = kept.withColumns({"__whole": whole, "__doc": doc})
    joined = placed.join(gone.withColumnsRenamed({"whole": "__whole", "doc": "__doc", "gone": "__gone"}), ["__whole", "__doc"], "left")
    split = F.split(F.col("text").cast("string"), "\n")
    numbers = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("__gone"))
    parts = joined.withColumn("__lines", split).withColumn("__kept", numbers)
    text = F.array_join(F.transform("__kept", lambda i: F.get("__lines", i)), "\n")
    return parts.select(
        *(F.when(F.col("__gone").isNull(), F.col("text")).otherwise(text).alias("text") if c == "text" else F.col(f"`{c}`") for c in kept.columns),
        F.when(F.col("__lines").isNull(), 0).otherwise(F.size("__lines")).cast("bigint").alias("n_lines"),
        *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_equal", "n_near")),
    )
