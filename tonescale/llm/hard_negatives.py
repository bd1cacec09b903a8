"""Hard negatives of anchor vectors by rotated one-bit codes.

Components are integers, floor(scale * x).  A vector is rotated (random signs and
Hadamard transforms, twice) and coded by the signs of its D components: b, a unit
vector with components of +-1/sqrt(D).  Stored with it is its alignment a = <x, b>.
What a b leaves is orthogonal to b and is rotated and coded again, a few times, so
x = a1 b1 + a2 b2 + ... + rest, with the norm r of the rest stored, too.

For an anchor q, each <q, b> is estimated by popcounts of the code against bit planes
of the quantised anchor; its error is at most the norm of what the planes leave.  The
rest is orthogonal to the last code, so by Cauchy-Schwarz it adds at most
r sqrt(|q|^2 - <q, b>^2).  So every row has an interval that holds its score for
certain, and only rows whose interval may reach the result are scored, in integers.

Rows and anchors meet in the cells of a grid of bounded blocks, dealt by hash.  A
cell returns at most the first few rows of an anchor; their merge is exact.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonescale.llm.batches import bound_batches
from tonescale.llm.vectors import blob, matrix, vectors_of
from tonescale.runtime import write_once

POSITIVES, NEGATIVES, EVERY, SCALE = 5, 3, 50, 256
#: Bounds of a negative's score, in hundredths of the positive's.
LEAST, MOST = 50, 95
#: Sizes of the blocks that meet in one cell, codes of a row, and bit planes of an anchor.
ROWS, ANCHORS, CODES, PLANES = 8192, 2048, 5, 6
# Weights of the planes; their sums of counts stay exact in single precision up to 2^18 components.
PLACES = (1 << np.arange(PLANES)).astype(np.float32)
#: Relative slack of the intervals for rounding in double precision.
SLACK = 1e-9
EXACT, LONG = float(1 << 53), (-(1 << 63), (1 << 63) - 1)

CODED = "vec_id bigint, label bigint, size int, vector binary, code binary, align binary, residual double"


# ---- codes ---------------------------------------------------------------------------------


def width(size: int) -> int:
    """Components of a rotated vector: a power of two, 64 at least."""
    return max(64, 1 << (size - 1).bit_length()) if size else 64


@functools.lru_cache(8)
def signs(wide: int) -> np.ndarray:
    return np.random.default_rng([wide, 12]).choice((-1.0, 1.0), (CODES, 2, wide))


def padded(rows: np.ndarray) -> np.ndarray:
    out = np.zeros((len(rows), width(rows.shape[1])))
    out[:, : rows.shape[1]] = rows
    return out


def rotated(rows: np.ndarray, stage: int) -> np.ndarray:
    """An orthogonal image of the rows."""
    count, wide = rows.shape
    for flips in signs(wide)[stage]:
        rows = rows * flips
        half = 1
        while half < wide:
            pairs = rows.reshape(count, -1, 2, half)
            rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(count, wide)
            half *= 2
        rows = rows / np.sqrt(wide)
    return rows


def codes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs and alignments of every code, and the norm of the rest."""
    rest, packed, aligned = padded(rows), [], []
    root = np.sqrt(rest.shape[1])
    for stage in range(CODES):
        rest = rotated(rest, stage)
        positive = rest > 0
        align = np.abs(rest).sum(axis=1) / root
        packed.append(np.packbits(positive, axis=1, bitorder="little"))
        aligned.append(align)
        rest = rest - np.where(positive, 1.0, -1.0) * (align / root)[:, None]
    return np.concatenate(packed, axis=1), np.stack(aligned, axis=1), np.sqrt((rest * rest).sum(axis=1))


class Query:
    """Bit planes of an anchor for every code and the errors that they leave."""

    def __init__(self, norm: float, root: float, stages: list[tuple]):
        self.norm, self.root, self.stages = norm, root, stages

    @classmethod
    def of(cls, anchors: np.ndarray) -> list["Query"]:
        """One for each row, rotated together."""
        turned, norms, by_code = padded(anchors), np.sqrt((anchors * anchors).sum(axis=1)), []
        for stage in range(CODES):
            turned = rotated(turned, stage)
            low = turned.min(axis=1)
            step = (turned.max(axis=1) - low) / ((1 << PLANES) - 1)
            step[step == 0] = 1.0
            levels = np.rint((turned - low[:, None]) / step[:, None]).astype(np.int64)
            near = low[:, None] + step[:, None] * levels
            bits = (levels[:, None] >> np.arange(PLANES)[:, None]) & 1
            planes = np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view(np.uint64)
            errors = np.sqrt(((turned - near) ** 2).sum(axis=1))
            by_code.append(list(zip(planes, low, step, near.sum(axis=1), errors)))
        root = math.sqrt(turned.shape[1])
        return [cls(float(norm), root, list(stages)) for norm, stages in zip(norms, zip(*by_code))]

    def bounds(self, block: "Block", at: slice) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible scores of the block's rows ``at``."""
        score, reach = 0, 0
        for (planes, low, step, total, error), words, ones, align in zip(self.stages, block.words, block.ones, block.align):
            counts = 0
            for word, plane in zip(words, planes.T):
                counts = counts + np.bitwise_count(word[at] & plane[:, None]).astype(np.float32)
            near = (2 * step / self.root) * (PLACES @ counts).astype(np.float64)
            near += (2 * low / self.root) * ones[at]
            near -= total / self.root
            score = score + align[at] * near
            reach = reach + (error + SLACK * self.norm) * align[at]
        aside = np.sqrt(np.maximum(self.norm**2 - np.maximum(np.abs(near) - error, 0) ** 2, 0))
        reach += (aside + SLACK * self.norm) * block.residual[at]
        low, high = score - reach, score + reach
        if not np.isfinite(high).all():  # beyond double precision: anything is possible
            low, high = np.nan_to_num(low, nan=-np.inf), np.nan_to_num(high, nan=np.inf)
        return np.maximum(low, LONG[0]), np.minimum(high, LONG[1])


class Block:
    """Rows of one vector size in a cell, sorted by label."""

    def __init__(self, table: pa.Table, size: int):
        table = table.sort_by("label")
        self.ids, self.labels = (table.column(name).to_numpy() for name in ("vec_id", "label"))
        self.vectors = matrix(table.column("vector"), size)
        self.coded(np.frombuffer(b"".join(c.as_buffer().to_pybytes() for c in table.column("code")), np.uint64), matrix(table.column("align"), CODES))
        self.residual = table.column("residual").to_numpy()
        found, starts = np.unique(self.labels, return_index=True)
        ends = [*starts[1:].tolist(), len(self.labels)]
        self.spans = {label: slice(*span) for label, span in zip(found.tolist(), zip(starts.tolist(), ends))}
        self.greatest = np.abs(self.vectors).max(initial=0)

    def coded(self, codes: np.ndarray, align: np.ndarray) -> None:
        """Words of the codes by code and place, their numbers of ones, and alignments."""
        self.words = np.ascontiguousarray(codes.reshape(len(align), CODES, -1).transpose(1, 2, 0)) if len(align) else np.empty((CODES, 1, 0), np.uint64)
        self.ones = np.bitwise_count(self.words).sum(axis=1, dtype=np.int64)
        self.align = np.ascontiguousarray(align.T)

    def of_label(self, label: int) -> slice:
        """Rows of a label, which follow each other."""
        return self.spans.get(label, slice(0, 0))

    def scores(self, at: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Exact inner products."""
        if not anchor.size or self.greatest * np.abs(anchor).max() * len(anchor) < EXACT:
            found = self.vectors[at] @ anchor if 4 * len(at) < len(self.vectors) else (self.vectors @ anchor)[at]
            return found.astype(np.int64)
        whole = [int(x) for x in anchor]
        exact = (sum(int(x) * y for x, y in zip(row, whole)) for row in self.vectors[at])
        return np.fromiter((min(max(s, LONG[0]), LONG[1]) for s in exact), np.int64, len(at))

    def best_first(self, at: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores, higher scores and smaller ids first."""
        order = np.lexsort((self.ids[at], ~scores))
        return self.ids[at[order]], scores[order]


def greatest(values: np.ndarray, place: int) -> float:
    """The place-th greatest value; less than all if there are fewer."""
    return np.partition(values, -place)[-place] if len(values) >= place else -np.inf


def coded(vectors: DataFrame, scale: int) -> DataFrame:
    """The rows that take part, as integers with their codes."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels = batch.column("vec_id").to_pylist(), batch.column("label").to_pylist()
            by_size: dict[int, list[tuple]] = {}
            for i, label, vector in zip(ids, labels, vectors_of(batch.column("vector"))):
                if i is not None and label is not None and vector is not None:
                    by_size.setdefault(len(vector), []).append((i, label, np.floor(scale * vector)))
            for size, rows in by_size.items():
                i, label, whole = zip(*rows)
                packed, align, residual = codes(np.stack(whole))
                columns = (i, label, [size] * len(i), map(blob, whole), map(bytes, packed), map(blob, align), residual)
                types = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.float64())
                names = [c.split()[0] for c in CODED.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    bound_batches(vectors.sparkSession)
    narrow = vectors.select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), F.col("vector"))
    return write_once(narrow.mapInArrow(code, CODED), "codes")


# ---- the grid ------------------------------------------------------------------------------

Found = Callable[[Block, Query, np.ndarray, dict], Iterator[tuple]]


def searched(rows: DataFrame, anchors: DataFrame, grid: tuple[int, int], find: Found, schema: str) -> DataFrame:
    """What ``find`` returns for every anchor in every cell of the grid.

    ``anchors`` have the columns anchor_key, anchor_id, label, size, vector and lists
    of positive ids and scores.  Repeated rows meet in one block, and count once there.
    """
    lows, highs = grid
    none = F.lit(None)
    columns = ["vec_id", "label", "size", "vector", "code", "align", "residual"]
    own = rows.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(lows)).alias("low"), F.explode(F.sequence(F.lit(0), F.lit(highs - 1))).alias("high"),
        none.cast("bigint").alias("anchor_key"), *columns, *[none.cast("array<bigint>").alias(n) for n in ("positive_ids", "positive_scores")],
    )
    sent = anchors.select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(lows - 1).cast("bigint"))).alias("low"), F.pmod(F.col("anchor_key"), F.lit(highs)).cast("int").alias("high"),
        "anchor_key", F.col("anchor_id").alias("vec_id"), "label", "size", "vector", none.cast("binary").alias("code"),
        none.cast("binary").alias("align"), none.cast("double").alias("residual"), "positive_ids", "positive_scores",
    )
    names = [c.split()[0] for c in schema.split(", ")]
    types = {"int": pa.int32(), "bigint": pa.int64()}
    kinds = [types[c.split()[1]] for c in schema.split(", ")]

    def cell(table: pa.Table) -> pa.Table:
        found: list[tuple] = []
        queries = table.filter(pc.is_valid(table.column("anchor_key")))
        table = table.filter(pc.is_null(table.column("anchor_key")))
        for size in set(queries.column("size").to_pylist()):
            part = table.filter(pc.equal(table.column("size"), size))
            part = part.group_by(["vec_id", "label", "vector"], use_threads=False).aggregate([(n, "min") for n in ("code", "align", "residual")])
            block = Block(part.rename_columns([n.removesuffix("_min") for n in part.column_names]), size)
            asked = queries.filter(pc.equal(queries.column("size"), size))
            anchors = matrix(asked.column("vector"), size)
            for row, anchor, query in zip(asked.drop_columns(["vector"]).to_pylist(), anchors, Query.of(anchors)):
                found += ((row["anchor_key"], row["vec_id"], *f) for f in find(block, query, anchor, row))
        columns = zip(*found) if found else [[]] * len(names)
        return pa.table([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=names)

    return own.union(sent).groupBy("low", "high").applyInArrow(cell, schema)


def find_positives(limit: int) -> Found:
    def find(block: Block, query: Query, anchor: np.ndarray, row: dict) -> Iterator[tuple]:
        span = block.of_label(row["label"])
        own = block.ids[span] != row["vec_id"]
        if len(own) > limit:
            low, high = query.bounds(block, span)
            own &= high >= greatest(low[own], limit)
        at = np.arange(span.start, span.stop)[own]
        ids, scores = block.best_first(at, block.scores(at, anchor))
        yield from zip(ids[:limit].tolist(), scores[:limit].tolist())

    return find


def find_negatives(limit: int, least: int, most: int) -> Found:
    def find(block: Block, query: Query, anchor: np.ndarray, row: dict) -> Iterator[tuple]:
        windows = {s: (-(-least * s // 100), most * s // 100) for s in row["positive_scores"]}
        windows = {s: w for s, w in windows.items() if w[0] <= w[1]}
        if not windows or not len(block.ids):
            return
        low, high = query.bounds(block, slice(None))
        possible = (high >= min(w[0] for w in windows.values())) & (low <= max(w[1] for w in windows.values()))
        possible &= block.ids != row["vec_id"]
        possible[block.of_label(row["label"])] = False
        at = np.flatnonzero(possible)
        low, high, needed = low[at], high[at], np.zeros(len(at), bool)
        for bottom, top in windows.values():
            sure = (low >= bottom) & (high <= top)
            needed |= (high >= max(bottom, greatest(low[sure], limit))) & (low <= top)
        at = at[needed]
        scores = block.scores(at, anchor)
        fits = scores >= min(bottom for bottom, _ in windows.values())
        ids, scores = block.best_first(at[fits], scores[fits])
        found = {}
        for s, (bottom, top) in windows.items():
            start = np.searchsorted(~scores, ~np.int64(top))  # the first score that is not above the top
            inside = slice(start, start + limit)
            found[s] = [p for p in zip(ids[inside].tolist(), scores[inside].tolist()) if p[1] >= bottom]
        for place, (i, s) in enumerate(zip(row["positive_ids"], row["positive_scores"])):
            yield from ((place, i, s, *negative) for negative in found.get(s, ()))

    return find


def hard_negatives(
    vectors: DataFrame, vector: str = "embedding", every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
    least: int = LEAST, most: int = MOST, scale: int = SCALE, rows_per_block: int = ROWS, anchors_per_block: int = ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id is divisible by ``every``; a positive is one of
    an anchor's first rows of the same label, a negative one of the first of other
    labels whose score is between ``least`` and ``most`` hundredths of the positive's.

    A row without id, label or vector, or with a missing or non-finite component,
    takes no part.  Only vectors of one size are compared; an empty one scores 0.
    Rows equal in id, label and vector count once; other rows that share an id are
    rows of their own, but never partners of an anchor of that id.  A score beyond 64
    bits counts as the nearest 64-bit number.  Other columns are ignored, an empty table
    gives no rows.
    """
    rows = coded(vectors.select("vec_id", "label", F.col(vector).alias("vector")), scale)
    key = F.xxhash64("vec_id", "label", "vector").alias("anchor_key")
    chosen = rows.filter(F.col("vec_id") % every == 0).select(key, F.col("vec_id").alias("anchor_id"), "label", "size", "vector")
    anchors = write_once(chosen.dropDuplicates(["anchor_key"]), "anchors")
    grid = tuple(max(1, -(-n // block)) for n, block in ((rows.count(), rows_per_block), (anchors.count(), anchors_per_block)))

    none = F.lit(None).cast("array<bigint>")
    asked = anchors.withColumns({"positive_ids": none, "positive_scores": none})
    found = searched(rows, asked, grid, find_positives(positives), "anchor_key bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
    order = Window.partitionBy("anchor_key").orderBy(F.desc("positive_score"), "positive_id")
    first = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives)
    lists = first.groupBy("anchor_key").agg(F.array_sort(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("p"))
    lists = lists.select("anchor_key", F.col("p.positive_id").alias("positive_ids"), F.col("p.positive_score").alias("positive_scores"))
    asked = write_once(anchors.join(lists, "anchor_key"), "positives")

    schema = "anchor_key bigint, anchor_id bigint, place int, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"
    found = searched(rows, asked, grid, find_negatives(negatives, least, most), schema)
    order = Window.partitionBy("anchor_key", "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
