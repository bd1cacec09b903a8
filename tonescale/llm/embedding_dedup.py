"""Near duplicates of vectors by sorted projection passes.

Vectors with equal label and components form a class.  Each pass hashes a class by
the signs of random projections, concatenated to one number, sorts all classes by
it and compares each with the next ones in that order.  Vectors at a small angle
share a long beginning of their hashes in some pass, and so come close.  Verified
pairs of all passes are united to components.

The window of a pass is bounded, and a family of near copies may be larger.  So the
members of every component meet once more, all of them, to count their links: in the
order of their angle to the component's mean, in cells of two blocks.  Two blocks
whose angles add up to less than that of the least similarity are linked throughout,
by the triangle inequality, and two whose angles differ by more are not linked at
all; only the other cells are compared.  No pair leaves a cell, just counts.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonescale.llm.batches import bound_batches
from tonescale.llm.components import connected
from tonescale.llm.vectors import blob, matrix, units, vectors_of
from tonescale.operators.numbering import with_positions
from tonescale.runtime import write_once

LEAST, WINDOW, RECALL = 0.93, 64, 0.999
BITS, BLOCK, CELL = 48, 2048, 1024
#: Classes that hold more than this part of all rows reach the rows by broadcast; there are fewer of them than its inverse.
HOT = 1 / 1024
#: Slack of angles for rounding, in radians.
SLACK = 1e-6


def passes_for(classes: int, least: float = LEAST, window: int = WINDOW, recall: float = RECALL) -> int:
    """Passes after which a pair at the least similarity has come close with probability ``recall``.

    A window takes in the classes that share about log2(classes / window) first
    bits; each bit of a pair agrees with probability 1 - angle / pi.
    """
    bits = max(1, math.ceil(math.log2(max(classes / window, 1))) + 1)
    close = (1 - math.acos(least) / math.pi) ** bits
    return max(2, math.ceil(math.log(1 - recall) / math.log(1 - close)))


# ---- classes -------------------------------------------------------------------------------


def fingerprints(vectors: DataFrame) -> DataFrame:
    """vec_id, label, size, vector and a 128-bit key of label and vector; no key for what links with nothing."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, blobs = [], [], []
            for label, vector in zip(batch.column("label").to_pylist(), vectors_of(batch.column("vector"))):
                able = label is not None and vector is not None and vector.any()
                data = blob(vector + 0.0) if able else None  # -0.0 becomes 0.0
                keys.append(hashlib.blake2b(data, digest_size=16, key=str(label).encode()).digest() if able else None)
                sizes.append(len(vector) if able else None)
                blobs.append(data)
            arrays = [pa.array(sizes, pa.int32()), pa.array(blobs, pa.binary()), pa.array(keys, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), *arrays], names=["vec_id", "label", "size", "vector", "key"])

    bound_batches(vectors.sparkSession)
    narrow = vectors.select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), F.col("vector"))
    return narrow.mapInArrow(find, "vec_id bigint, label bigint, size int, vector binary, key binary")


def classes_of(rows: DataFrame) -> DataFrame:
    """class_id, key, label, size, vector, least and copies of every class; copies merge in their tasks."""
    found = rows.filter("key IS NOT NULL").groupBy("key", "label", "size", "vector")
    found = found.agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    return write_once(found.withColumn("class_id", F.monotonically_increasing_id()), "vector-classes")


def by_size(table: pa.Table, name: str = "vector") -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and unit vectors of the rows of each size."""
    sizes = table.column("size").to_numpy()
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, units(matrix(table.column(name).take(pa.array(at)), int(size)))


# ---- passes --------------------------------------------------------------------------------


@functools.lru_cache(4)
def planes(size: int, number: int) -> np.ndarray:
    return np.random.default_rng([size, number, 13]).standard_normal((size, BITS))


def hashed(classes: DataFrame, passes: int) -> DataFrame:
    """A row for each class and pass, with the hash of the pass."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(BITS, dtype=np.int64)[::-1]
        for batch in batches:
            for at, rows in by_size(pa.table(batch)):
                own = batch.take(pa.array(at))
                for number in range(passes):
                    code = (rows @ planes(rows.shape[1], number) > 0) @ weights
                    arrays = [pa.array(np.full(len(at), number, np.int32)), pa.array(code)]
                    yield pa.RecordBatch.from_arrays([*arrays, *own.columns], names=["pass", "code", *own.schema.names])

    return classes.select("label", "size", "class_id", "vector").mapInArrow(explode, "pass int, code bigint, label bigint, size int, class_id bigint, vector binary")


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Of links (a, b) as few as connect the same nodes."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = root(x), root(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            kept.append((x, y))
    return kept


def window_links(classes: DataFrame, passes: int, least: float, window: int) -> DataFrame:
    """Links that connect what the windows of all passes find, as (a, b) of class ids."""

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("position")
        keys = np.stack([table.column(n).to_numpy() for n in ("pass", "label", "size")])
        ids, head = table.column("class_id").to_numpy(), table.column("head").to_numpy(zero_copy_only=False)
        found_a, found_b = [], []
        for at, rows in by_size(table):
            own = keys[:, at]
            for k in range(1, min(window, len(at) - 1) + 1):
                same = (own[:, k:] == own[:, :-k]).all(axis=0) & ~head[at[k:]]
                close = np.flatnonzero(same & (np.einsum("ij,ij->i", rows[:-k], rows[k:]) >= least))
                found_a.append(ids[at[close]])
                found_b.append(ids[at[close + k]])
        none = [np.empty(0, np.int64)]
        kept = forest(np.concatenate(found_a or none), np.concatenate(found_b or none))
        return pa.table([pa.array([p[i] for p in kept], pa.int64()) for i in (0, 1)], names=["a", "b"])

    placed = with_positions(hashed(classes, passes), ["pass", "label", "size", "code", "class_id"])
    block = (F.col("position") / BLOCK).cast("bigint")
    own = placed.withColumns({"block": block, "head": F.lit(False)})
    # the last rows of a block come before the next one's first
    tail = own.filter(F.col("position") % BLOCK >= BLOCK - window).withColumns({"block": F.col("block") + 1, "head": F.lit(True)})
    return own.union(tail).groupBy("block").applyInArrow(compare, "a bigint, b bigint")


# ---- counts --------------------------------------------------------------------------------


def angles(members: DataFrame) -> DataFrame:
    """Members with their angle to the mean of their component; components of one block need none.

    Sums are made by salted parts, and a component's mean goes to each of its parts, so no task holds a whole one.
    """
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > CELL)
    sizes = sizes.select("component", F.ceil(F.col("m") / CELL).cast("bigint").alias("parts"))
    parted = members.join(sizes, "component", "left").withColumn("part", F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("class_id"), F.col("parts"))))
    large = parted.filter("parts IS NOT NULL")

    def add(table: pa.Table) -> pa.Table:
        (_, rows), = by_size(table)
        first = table.slice(0, 1)
        total = pa.array([rows.sum(axis=0).tobytes()], pa.binary())
        return pa.table([first.column("component"), first.column("parts"), first.column("size"), total], names=["component", "parts", "size", "total"])

    def mean(table: pa.Table) -> pa.Table:
        total = matrix(table.column("total"), table.column("size")[0].as_py()).sum(axis=0)
        first = table.slice(0, 1)
        return pa.table([first.column("component"), first.column("parts"), pa.array([total.tobytes()], pa.binary())], names=["component", "parts", "centre"])

    sums = large.select("component", "part", "parts", "size", "vector").groupBy("component", "part").applyInArrow(add, "component bigint, parts bigint, size int, total binary")
    centres = write_once(sums.groupBy("component").applyInArrow(mean, "component bigint, parts bigint, centre binary"), "centres")
    dealt = centres.select("component", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"), "centre")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.full(batch.num_rows, math.pi)
            table = pa.table(batch)
            known = np.flatnonzero(table.column("centre").is_valid().to_numpy(zero_copy_only=False))
            if len(known):
                part = table.take(pa.array(known))
                for (at, rows), (_, means) in zip(by_size(part), by_size(part, "centre")):
                    found[known[at]] = np.arccos(np.clip((rows * means).sum(axis=1), -1, 1))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(found)], names=[*names, "angle"])

    names = ["component", "class_id", "size", "vector", "copies"]
    joined = parted.join(dealt, ["component", "part"], "left").select(*names, "centre")
    return joined.mapInArrow(measure, "component bigint, class_id bigint, size int, vector binary, copies bigint, angle double")


def link_counts(members: DataFrame, least: float) -> DataFrame:
    """class_id and the number of rows in the same component that link with it, its own among them."""
    limit = math.acos(least)
    placed = write_once(with_positions(angles(members), ["component", "angle", "class_id"]), "placed-members")
    starts = placed.groupBy("component").agg(F.min("position").alias("start"))
    # Few rows a component and many components: neither side of this join has a hot key but the members'.
    blocks = placed.groupBy("component", (F.col("position") / CELL).cast("bigint").alias("block")).agg(
        F.min("angle").alias("low"), F.max("angle").alias("high"), F.sum("copies").alias("copies")
    )

    def partners(table: pa.Table) -> pa.Table:
        """For each block: rows surely linked, and the range of blocks to compare with (least and greatest)."""
        table = table.sort_by("block")
        low, high, copies = (table.column(n).to_numpy() for n in ("low", "high", "copies"))
        sure = np.searchsorted(high, limit - SLACK - high, side="right")
        first = np.maximum(sure, np.searchsorted(high, low - limit - SLACK))
        last = np.searchsorted(low, high + limit + SLACK, side="right") - 1
        number = table.column("block").to_numpy()
        rows = np.r_[0, np.cumsum(copies)][sure]
        arrays = [table.column("component"), table.column("block"), pa.array(rows), pa.array(first + number[0]), pa.array(last + number[0])]
        return pa.table(arrays, names=["component", "block", "sure", "first", "last"])

    ranges = write_once(blocks.groupBy("component").applyInArrow(partners, "component bigint, block bigint, sure bigint, first bigint, last bigint"), "block-partners")
    own = placed.withColumn("block", (F.col("position") / CELL).cast("bigint")).join(ranges, ["component", "block"])
    certain = own.filter("sure > 0").select("class_id", F.col("sure").alias("n"))
    columns = ["class_id", "size", "vector", "copies"]
    lower = own.filter("last >= greatest(block, first)").select("component", F.col("block").alias("low"), F.explode(F.expr("sequence(greatest(block, first), last)")).alias("high"), F.lit(0).alias("side"), *columns)
    upper = own.filter("first < block").select("component", F.explode(F.expr("sequence(first, block - 1)")).alias("low"), F.col("block").alias("high"), F.lit(1).alias("side"), *columns)

    def compare(table: pa.Table) -> pa.Table:
        side, ids, copies = (table.column(n).to_numpy() for n in ("side", "class_id", "copies"))
        (_, rows), = by_size(table)
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(right):  # a block with itself; a vector links with itself whatever the rounding
            linked = rows[left] @ rows[left].T >= least
            np.fill_diagonal(linked, True)
            number, at = linked @ copies[left], left
        else:
            linked = rows[left] @ rows[right].T >= least
            number, at = np.r_[linked @ copies[right], copies[left] @ linked], np.r_[left, right]
        return pa.table([pa.array(ids[at]), pa.array(number.astype(np.int64))], names=["class_id", "n"])

    compared = lower.union(upper).groupBy("component", "low", "high").applyInArrow(compare, "class_id bigint, n bigint")
    return compared.union(certain).groupBy("class_id").agg(F.sum("n").alias("n"))


def vector_components(
    vectors: DataFrame, vector: str = "embedding", least: float = LEAST, window: int = WINDOW, recall: float = RECALL
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    Rows link when their labels are equal and their cosine is ``least`` or more.
    A pair at just that similarity is found with probability ``recall``, a closer one
    more surely; links within a component are counted whole.  Missing labels and
    vectors, zero vectors, those with a missing or non-finite component and those of
    different sizes link with nothing; such a row is a component of its own.

    ``component_id`` is the smallest vec_id of the component; a missing id is it only
    where there is no other, and such a row is not ``kept``.  Rows that share an id
    are rows of their own.  Other columns are ignored; an empty table gives no rows.
    """
    rows = write_once(fingerprints(vectors.select("vec_id", "label", F.col(vector).alias("vector"))), "vectors")
    classes = classes_of(rows)
    most = classes.groupBy("label", "size").count().agg(F.max("count")).first()[0] or 1
    labels = connected(window_links(classes, passes_for(most, least, window, recall), least, window))
    members = classes.join(labels.select(F.col("node").alias("class_id"), F.col("label").alias("component")), "class_id")
    members = write_once(members.select("component", "class_id", "key", "size", "vector", "copies", "least"), "members")
    counts = link_counts(members.select("component", "class_id", "size", "vector", "copies"), least)
    smallest = members.groupBy("component").agg(F.min("least").alias("component_id"))
    joined = members.select("component", "class_id", "key", "copies").join(counts, "class_id").join(smallest, "component")
    linked = joined.select("key", "copies", (F.col("n") - 1).alias("n_links"), "component_id")
    alone = classes.filter("copies > 1").join(members.select("class_id"), "class_id", "left_anti")
    found = write_once(linked.union(alone.select("key", "copies", F.col("copies") - 1, "least")), "linked-classes")

    # Rows take their class's result; the few classes of many rows by broadcast, so no key of the shuffle is hot.
    hot = found.filter(F.col("copies") > F.lit(HOT) * rows.count()).drop("copies")
    numbers = ["n_links", "component_id"]
    first = rows.select("vec_id", "key").join(F.broadcast(hot), "key", "left")
    done = first.filter("n_links IS NOT NULL").select("vec_id", *numbers)
    rest = first.filter("n_links IS NULL").select("vec_id", "key").join(found.drop("copies"), "key", "left").select("vec_id", *numbers)
    links = F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")
    result = done.union(rest).select("vec_id", links, component)
    return result.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
