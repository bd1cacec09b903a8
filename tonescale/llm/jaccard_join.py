"""N-gram Jaccard join by groups of equal prefixes.

Two documents link when their sets of word shingles have a Jaccard similarity of
0.8 or more.  In one order of all shingles, linked sets share a shingle within
their first n - ceil(0.8 n) + 1.  The order puts shingles of many documents last.

1. Shingle frequencies are counted over all documents (sorted blocks of numbers
   by range).  Shingles of one document can match nothing and leave the
   prefixes; the commonest ones get their frequency as rank.
2. Documents with equal sets form a class, classes with equal prefix and size a
   group.  Only groups are joined: by prefix shingle, filtered by size and by the
   overlap that their positions leave possible.
3. Groups expand to their classes.  Bits that only one of two sets holds bound a
   pair's overlap; what passes is verified on whole sets.  Large
   buckets first link to their best members alone; what these links leave in
   different components is then compared in blocks of whole sets; of a block's
   links those that join components leave it, fewer than its members.  Nothing is
   skipped but pairs already connected.
4. Components come from the verified links; those of the second comparison join
   components of the first.

Equality of shingles and sets is that of 64-bit numbers.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonescale.llm.batches import texts_of
from tonescale.llm.components import connected
from tonescale.llm.shingles import digest, shingle_set
from tonescale.runtime import write_once

COMMON = 16
#: Bounds of what is broadcast: frequencies of the commonest shingles, bits that mark repeated ones.
MOST_COMMON, MOST_BITS = 1_000_000, 1 << 28
TOKENS_PER_RANGE = 2_000_000
SMALL, PIVOTS, BLOCK = 48, 8, 1024
#: Most bits of a sketch, most bytes compared at once, shingles that count as one member of a block.
SKETCH_BITS, COMPARED, MEMBER = 1 << 15, 1 << 24, 1000

I64 = pa.int64()


def longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64, copy=False).view(np.int64), I64)


# ---- frequencies ---------------------------------------------------------------------------


def _pack_sorted(keys: np.ndarray) -> bytes:
    return zlib.compress(np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpack_sorted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


class Frequencies:
    """Document frequencies of the commonest shingles and a bit for each repeated one."""

    def __init__(self, bits: int, common: np.ndarray, counts: np.ndarray, repeated: np.ndarray):
        self.shift, self.common, self.counts, self.repeated = np.uint64(64 - bits), common, counts, repeated
        self.bit_shift = np.uint64(64 - int(math.log2(len(repeated) * 8)))

    def ranks(self, shingles: np.ndarray) -> np.ndarray | None:
        """Frequencies, 0 for what is not common; nothing if none is."""
        if not len(self.common):
            return None
        keys = shingles >> self.shift
        at = np.minimum(np.searchsorted(self.common, keys), len(self.common) - 1)
        hit = self.common[at] == keys
        return np.where(hit, self.counts[at], 0) if hit.any() else None

    def is_repeated(self, shingles: np.ndarray) -> np.ndarray:
        at = shingles >> self.bit_shift
        return (self.repeated[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _steps(counts: np.ndarray) -> np.ndarray:
    """Counts as steps of a scale with 64 steps a doubling, so a fixed number whatever the counts."""
    return np.floor(64 * np.log2(counts)).astype(np.int32)


def commonest(found: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of about the MOST_COMMON commonest shingles; only these reach the driver.

    A histogram gives the step down to which all fit.  Of the next step a slice of
    the keys fills up; keys are hashes, so a slice of the numbers is one of the keys.
    """

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            for keys, counts in zip(batch.column("keys"), batch.column("counts")):
                yield np.frombuffer(keys.as_buffer(), np.uint64), np.frombuffer(counts.as_buffer(), np.int64)

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, counts in unpacked(batches):
            steps, sizes = np.unique(_steps(counts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(steps, pa.int32()), pa.array(sizes, I64)], names=["step", "n"])

    packed = found.select("keys", "counts")
    sizes = packed.mapInArrow(histogram, "step int, n bigint").groupBy("step").agg(F.sum("n").alias("n"))
    room, step, part = MOST_COMMON, -1, 0.0
    for r in sizes.orderBy(F.desc("step")).collect():
        if r.n > room:
            step, part = r.step, room / r.n
            break
        room -= r.n
    most = np.uint64(int(part * (1 << bits)))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, counts in unpacked(batches):
            steps = _steps(counts)
            keep = (steps > step) | ((steps == step) & (keys < most))
            columns = [[keys[keep].tobytes()], [counts[keep].tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=["keys", "counts"])

    rows = packed.mapInArrow(pick, "keys binary, counts binary").collect()
    keys = np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in rows] or [np.empty(0, np.uint64)])
    counts = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in rows] or [np.empty(0, np.int64)])
    return keys, counts


def frequencies(texts: DataFrame) -> Frequencies:
    """Counted over all documents; 8 bits finer than their number needs."""
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tokens = max(1024, size // 5)
    bits = min(60, math.ceil(math.log2(tokens)) + 8)
    wide = min(MOST_BITS.bit_length() - 1, math.ceil(math.log2(tokens)))
    ranges = 1 << min(wide - 3, max(3, math.ceil(math.log2(max(tokens / TOKENS_PER_RANGE, spark.sparkContext.defaultParallelism)))))
    range_shift, key_shift = np.uint64(64 - int(math.log2(ranges))), np.uint64(64 - bits)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def rows() -> pa.RecordBatch:
            found = np.sort(np.concatenate(held)) if held else np.empty(0, np.uint64)
            held.clear()
            parts, starts = np.unique(found >> range_shift, return_index=True)
            packed = [_pack_sorted(block >> key_shift) for block in np.split(found, starts[1:])] if len(found) else []
            return pa.RecordBatch.from_arrays([pa.array(parts.astype(np.int32)), pa.array(packed, pa.binary())], names=["part", "packed"])

        for batch in batches:
            held += [shingle_set(text.as_py()) for text in batch.column("text")]
            if sum(map(len, held)) > 2 * TOKENS_PER_RANGE:
                yield rows()
        yield rows()

    slice_bits = (1 << wide) // ranges

    def count(key: tuple, table: pa.Table) -> pa.Table:
        keys = np.concatenate([_unpack_sorted(b.as_py()) for b in table.column("packed")])
        keys, counts = np.unique(keys, return_counts=True)
        keys, counts = keys[counts > 1], counts[counts > 1]
        marks = np.zeros(slice_bits, np.uint8)
        marks[((keys >> np.uint64(bits - wide)) - np.uint64(key[0].as_py() * slice_bits)).astype(np.int64)] = 1
        top = counts >= COMMON
        columns = [[key[0].as_py()], [keys[top].tobytes()], [counts[top].astype(np.int64).tobytes()], [zlib.compress(np.packbits(marks, bitorder="little").tobytes(), 1)]]
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.binary(), pa.binary(), pa.binary()))], names=["part", "keys", "counts", "marks"])

    packed = texts.mapInArrow(blocks, "part int, packed binary")
    counted = packed.groupBy("part").applyInArrow(count, "part int, keys binary, counts binary, marks binary")
    found = write_once(counted, "frequencies")
    keys, counts = commonest(found, bits)
    by_key = np.argsort(keys)
    repeated = np.zeros((1 << wide) // 8, np.uint8)
    for r in found.select("part", "marks").collect():
        marks = np.frombuffer(zlib.decompress(r["marks"]), np.uint8)
        repeated[r["part"] * len(marks) : (r["part"] + 1) * len(marks)] = marks
    return Frequencies(bits, keys[by_key], counts[by_key], repeated)


# ---- prefixes and groups -------------------------------------------------------------------


def prefix(shingles: np.ndarray, known: Frequencies) -> tuple[np.ndarray, np.ndarray]:
    """The repeated shingles of a set's prefix and their places in the order."""
    size = len(shingles) - (4 * len(shingles) + 4) // 5 + 1
    ranks = known.ranks(shingles)
    first = shingles[:size] if ranks is None else shingles[np.lexsort((shingles, ranks))[:size]]
    keep = np.flatnonzero(known.is_repeated(first))
    return first[keep], keep


def described(texts: DataFrame, known: Frequencies) -> DataFrame:
    """doc_id, n, class_id, group_id, prefix, places and sketch of every document."""
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, classes, groups, firsts, places, sketches = [], [], [], [], [], []
            for text in batch.column("text"):
                shingles = shingle_set(text.as_py())
                own, place = prefix(shingles, shared.value) if len(shingles) else (shingles, np.empty(0, np.int64))
                sizes.append(len(shingles))
                classes.append(digest(shingles.tobytes()))
                firsts.append(own.tobytes())
                places.append(place.astype(np.uint32).tobytes())
                sketches.append(sketch(shingles) if len(own) else b"")
                groups.append(digest(len(shingles).to_bytes(8) + firsts[-1] + places[-1]))
            signed = [longs(np.array(c, np.uint64)) for c in (classes, groups)]
            blobs = [pa.array(c, pa.binary()) for c in (firsts, places, sketches)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, I64), *signed, *blobs], names=names)

    names = ["doc_id", "n", "class_id", "group_id", "prefix", "places", "sketch"]
    return texts.mapInArrow(describe, "doc_id bigint, n bigint, class_id bigint, group_id bigint, prefix binary, places binary, sketch binary")


def prefix_rows(groups: DataFrame) -> DataFrame:
    """token, group_id, spot (size and place in one number) of every group's prefix."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [np.frombuffer(b.as_py(), np.uint64) for b in batch.column("prefix")]
            places = [np.frombuffer(b.as_py(), np.uint32).astype(np.int64) for b in batch.column("places")]
            count = np.array([len(t) for t in tokens])
            if count.sum() == 0:
                continue
            sizes = batch.column("n").to_numpy()
            spot = (np.repeat(sizes, count) << 31) | np.concatenate(places)
            ids = np.repeat(batch.column("group_id").to_numpy(), count)
            yield pa.RecordBatch.from_arrays([longs(np.concatenate(tokens)), pa.array(ids), pa.array(spot)], names=["token", "group_id", "spot"])

    return groups.mapInArrow(explode, "token bigint, group_id bigint, spot bigint")


def possible(spot_a: np.ndarray, spot_b: np.ndarray) -> np.ndarray:
    """Whether sizes, and places of the first common shingle, allow a similarity of 0.8."""
    size_a, size_b = spot_a >> 31, spot_b >> 31
    low = (1 << 31) - 1
    overlap = np.minimum(size_a - (spot_a & low), size_b - (spot_b & low))
    return (5 * np.minimum(size_a, size_b) >= 4 * np.maximum(size_a, size_b)) & (9 * overlap >= 4 * (size_a + size_b))


def has_partner(spots: np.ndarray) -> np.ndarray:
    """Which members of a bucket have another that is possible.

    A member of size n and place p allows partners up to (9 (n - p) - 4 n) / 4.
    Sorted by size, the partners that it allows are a range, and one of them must
    allow its size; the largest allowed size in a range comes from a table of
    maxima over powers of two.
    """
    order = np.argsort(spots >> 31, kind="stable")
    sizes = (spots >> 31)[order]
    most = (9 * (sizes - (spots[order] & ((1 << 31) - 1))) - 4 * sizes) // 4
    low = np.searchsorted(sizes, (4 * sizes + 4) // 5)
    high = np.searchsorted(sizes, np.minimum(5 * sizes // 4, most), side="right")
    table = [most]
    while (step := 1 << (len(table) - 1)) * 2 <= len(most):
        table.append(np.maximum(table[-1][:-step], table[-1][step:]))

    def largest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.full(len(a), -1, np.int64)
        level = np.floor(np.log2(np.maximum(b - a, 1))).astype(int)
        for k, maxima in enumerate(table):
            at = np.flatnonzero((level == k) & (b > a))
            out[at] = np.maximum(maxima[a[at]], maxima[b[at] - (1 << k)])
        return out

    own = np.arange(len(sizes))
    best = np.maximum(largest(low, np.minimum(high, own)), largest(np.maximum(low, own + 1), high))
    found = np.empty(len(sizes), bool)
    found[order] = best >= sizes
    return found


def _whole(batches: Iterator[pa.RecordBatch], columns: int) -> list[np.ndarray]:
    """A partition's columns of numbers, which come first."""
    held = [[c.to_numpy() for c in batch.columns[:columns]] for batch in batches]
    return [np.concatenate([h[i] for h in held]) for i in range(columns)] if held else [np.empty(0, np.int64)] * columns


def _found(kind: int, *columns: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(np.full(len(columns[0]), kind, np.int32)), *(pa.array(c) for c in columns)]
    return pa.RecordBatch.from_arrays(arrays, names=["kind", "a", "b", "spot"])


def _unique_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1) if len(a) else np.empty((2, 0), np.int64)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind 0: candidate pairs of groups; kind 1: rows of large buckets, as token, group, spot."""
    tokens, groups, spots = _whole(batches, 3)
    order = np.lexsort((groups, spots & ((1 << 31) - 1), tokens))
    tokens, groups, spots = tokens[order], groups[order], spots[order]
    starts = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]]) if len(tokens) else np.empty(0, np.int64)
    sizes = np.diff(np.r_[starts, len(tokens)])
    first, second = [starts[sizes == 2]], [starts[sizes == 2] + 1]
    for start, size in zip(starts[(sizes > 2) & (sizes <= SMALL)], sizes[(sizes > 2) & (sizes <= SMALL)]):
        i, j = TRIANGLES.setdefault(size, np.triu_indices(size, 1))
        first.append(start + i)
        second.append(start + j)
    large = np.flatnonzero(sizes > SMALL)
    for start, size in zip(starts[large], sizes[large]):  # the members with the fewest shingles of their own, and the next ones
        for k in range(PIVOTS):
            rest = np.arange(start + k + 1, start + size)
            first.append(np.full(len(rest), start + k))
            second.append(rest)
        for k in range(1, 3):
            first.append(np.arange(start + PIVOTS, start + size - k))
            second.append(first[-1] + k)
        kept = start + np.flatnonzero(has_partner(spots[start : start + size]))
        yield _found(1, tokens[kept], groups[kept], spots[kept])
    i, j = np.concatenate(first), np.concatenate(second)
    fits = possible(spots[i], spots[j])
    a, b = _unique_pairs(groups[i[fits]], groups[j[fits]])
    yield _found(0, a, b, np.zeros(len(a), np.int64))


TRIANGLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that join different components, cell by cell.

    A cell compares a block of the members outside the bucket's largest component
    (``minor``) with a block of all members.  Members of one ``side`` other than 0
    are not compared.  Of links between the same components of a cell one is
    enough.  Pairs with a member whose set is not given are all returned.
    """
    held = list(batches)
    kind, token, other, low, high, minor, side, spots, ids, labels = _whole(iter(held), 10)
    sets = [np.frombuffer(blob or b"", np.uint64) for batch in held for blob in batch.column("shingles").to_pylist()]
    sketches = [sketch(own) if len(own) else b"" for own in sets]
    sizes = np.array([len(own) for own in sets], np.int64)
    order = np.lexsort((high, low, other, token, kind))
    keys = np.stack([kind, token, other, low, high])[:, order]
    new = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
    for part in np.split(order, np.flatnonzero(new) + 1):
        left, right = part[minor[part] == 1], part[minor[part] == 0]
        fits = labels[left][:, None] != labels[right]
        fits &= (side[left][:, None] == 0) | (side[left][:, None] != side[right])
        fits &= possible(spots[left][:, None], spots[right])
        i, j = (rows[at] for rows, at in zip((left, right), np.nonzero(fits)))
        close = linkable(sketches, spots >> 31, i, j)
        i, j = i[close], j[close]
        close = similar(sets, i, j)
        i, j = i[close], j[close]
        given = (sizes[i] > 0) & (sizes[j] > 0)
        kept = np.concatenate([np.flatnonzero(~given), np.flatnonzero(given)[joining(labels[i[given]], labels[j[given]])]])
        a, b = _unique_pairs(ids[i[kept]], ids[j[kept]])
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def crossed(rows: DataFrame) -> DataFrame:
    """Links that join members with different labels of every bucket (kind, token, other).

    Blocks hold BLOCK members, fewer where their sets are large.  Buckets of one label are left out.  One of two different labels is not the
    bucket's largest, so only members without that label are dealt against all:
    no more than about twice the pairs that have to be compared.
    """
    key = ["kind", "token", "other"]
    by_label = rows.groupBy(*key, "label").agg(F.sum(F.ceil(F.shiftright("spot", 31) / MEMBER)).alias("m"))
    largest = F.max(F.struct("m", "label"))
    apart = by_label.groupBy(*key).agg(F.sum("m").alias("all"), largest.alias("largest"), F.count("*").alias("n")).filter("n > 1")
    minors = F.ceil((F.col("all") - F.col("largest.m")) / BLOCK).cast("bigint")
    bounds = apart.select(*key, F.col("largest.label").alias("major"), minors.alias("lows"), F.ceil(F.col("all") / BLOCK).cast("bigint").alias("highs"))
    zero, one, hashed = F.lit(0).cast("bigint"), F.lit(1).cast("bigint"), F.xxhash64("class_id", "side")
    low, high = F.pmod(hashed, F.col("lows")), F.pmod(hashed, F.col("highs"))

    def cells(count: str, cell: Callable[[Column], list[Column]]) -> Column:
        return F.transform(F.sequence(zero, F.col(count) - 1), lambda i: F.struct(*(c.alias(n) for c, n in zip(cell(i), ("low", "high", "minor")))))

    everyone = cells("lows", lambda i: [i, high, zero])
    dealt = F.when(F.col("label") == F.col("major"), everyone).otherwise(F.concat(everyone, cells("highs", lambda i: [low, i, one])))
    columns = ["side", "spot", "class_id", "label", "shingles"]
    placed = rows.join(bounds, key).select(*key, F.explode(dealt).alias("cell"), *columns)
    return placed.select(*key, "cell.*", *columns).repartition(*key, "low", "high").mapInArrow(_cross, "a bigint, b bigint")


# ---- sketches ------------------------------------------------------------------------------


def sketch(shingles: np.ndarray) -> bytes:
    """A bit for the last digits of every shingle, among four to eight bits a shingle and at most SKETCH_BITS."""
    bits = min(SKETCH_BITS, max(64, 1 << (4 * len(shingles) - 1).bit_length()))
    marks = np.zeros(bits, np.uint8)
    marks[(shingles & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(marks).tobytes()


def folded(marks: np.ndarray, width: int) -> np.ndarray:
    """Rows of bits brought down to ``width`` words: fewer last digits."""
    while marks.shape[1] > width:
        half = marks.shape[1] // 2
        marks = marks[:, :half] | marks[:, half:]
    return marks


def overlap_allows(a: np.ndarray, size_a: np.ndarray, b: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Whether rows of bits allow a similarity of 0.8: a bit without its like is a shingle without its like, at least."""
    own_a, own_b = (np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64) for x, y in ((a, b), (b, a)))
    return 9 * np.minimum(size_a - own_a, size_b - own_b) >= 4 * (size_a + size_b)


def linkable(sketches: list[bytes], sizes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs (i, j) of members their sketches allow; a member without sketch may link with any."""
    keep = np.ones(len(i), bool)
    if not len(i):
        return keep
    used = np.unique(np.concatenate([i, j]))
    lengths = np.zeros(len(sketches), np.int64)
    lengths[used] = [len(sketches[k]) for k in used]
    place, marks = np.zeros(len(sketches), np.int64), {}
    for length in np.unique(lengths[used]):
        own = used[lengths[used] == length]
        place[own] = np.arange(len(own))
        marks[length] = np.frombuffer(b"".join(sketches[k] for k in own), np.uint64).reshape(len(own), -1)
    of_pair = np.stack([lengths[i], lengths[j]])
    for one, two in np.unique(of_pair, axis=1).T:
        width = min(one, two) // 8
        if not width:
            continue
        first, second = folded(marks[one], width), folded(marks[two], width)
        at = np.flatnonzero((of_pair[0] == one) & (of_pair[1] == two))
        for pairs in np.split(at, range(0, len(at), max(1, COMPARED // (8 * width)))[1:]):
            a, b = i[pairs], j[pairs]
            keep[pairs] = overlap_allows(first[place[a]], sizes[a], second[place[b]], sizes[b])
    return keep


def similar(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs (i, j) of members have sets similar enough, or one that is not given (empty)."""
    keep = np.ones(len(i), bool)
    if not len(i):
        return keep
    used, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    sizes = np.array([len(sets[k]) for k in used])
    codes = np.unique(np.concatenate([sets[k] for k in used]), return_inverse=True)[1]
    ends = np.cumsum(sizes)
    starts, marks = ends - sizes, np.zeros(len(codes) + 1, bool)
    left, right = at[: len(i)], at[len(i) :]
    given = np.flatnonzero((sizes[left] > 0) & (sizes[right] > 0))
    given = given[np.argsort(left[given], kind="stable")]
    step = max(1, COMPARED // (8 * max(1, sizes.max())))
    for same in np.split(given, np.flatnonzero(np.diff(left[given])) + 1):
        for pairs in np.split(same, range(step, len(same), step)):
            if not len(pairs):
                continue
            one, others = left[pairs[0]], right[pairs]
            own = codes[starts[one] : ends[one]]
            marks[own] = True
            before = np.cumsum(sizes[others]) - sizes[others]
            spread = np.arange(sizes[others].sum()) + np.repeat(starts[others] - before, sizes[others])
            common = np.add.reduceat(marks[codes[spread]], before, dtype=np.int64)
            keep[pairs] = 100 * common >= 80 * (sizes[one] + sizes[others] - common)
            marks[own] = False
    return keep


def joining(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Positions of links between labels a and b that hold the same labels together as all of them do."""
    pairs, places = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1, return_index=True)
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := above.get(x, x)) != x:
            above[x] = above.get(y, y)
            x = y
        return x

    kept = []
    for x, y, place in zip(*pairs.tolist(), places.tolist()):
        x, y = top(x), top(y)
        if x != y:
            above[max(x, y)] = min(x, y)
            kept.append(place)
    return np.array(kept, np.int64)


def sketched(candidates: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes and sketches of the classes allow."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketches = batch.column("sketch_a").to_pylist() + batch.column("sketch_b").to_pylist()
            sizes = np.concatenate([batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()])
            rows = np.arange(batch.num_rows)
            keep = linkable(sketches, sizes, rows, rows + batch.num_rows)
            kept = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"])
            yield kept.filter(pa.array(keep, pa.bool_()))

    one = classes.select(F.col("class_id").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
    two = classes.select(F.col("class_id").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
    both = candidates.join(two, "b").join(one, "a").filter("5 * least(n_a, n_b) >= 4 * greatest(n_a, n_b)")
    return both.select("a", "b", "n_a", "sketch_a", "n_b", "sketch_b").mapInArrow(check, "a bigint, b bigint")


# ---- verification --------------------------------------------------------------------------


def needed_bits(ids: DataFrame) -> np.ndarray:
    """Marks of a table of class ids, at most 2^27 bits however many there are."""
    wide = min(27, max(16, math.ceil(math.log2(16 * max(1, ids.count())))))
    per_row = 1 << 15

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - wide)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at // per_row), pa.array(at % per_row)], names=["row", "at"])

    marked = ids.mapInArrow(mark, "row bigint, at bigint").distinct()

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        marks = np.zeros(per_row, np.uint8)
        marks[table.column("at").to_numpy()] = 1
        return pa.table([pa.array([key[0].as_py()], I64), pa.array([zlib.compress(np.packbits(marks, bitorder="little").tobytes(), 1)], pa.binary())], names=["row", "marks"])

    bits = np.zeros((1 << wide) // 8, np.uint8)
    for r in marked.groupBy("row").applyInArrow(gather, "row bigint, marks binary").collect():
        bits[r["row"] * per_row // 8 : (r["row"] + 1) * per_row // 8] = np.frombuffer(zlib.decompress(r["marks"]), np.uint8)
    return bits


def sets_of(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """class_id and the whole set of the classes in ``ids`` (and of some more)."""
    shared = texts.sparkSession.sparkContext.broadcast(needed_bits(ids))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        shift = 64 - int(math.log2(len(bits) * 8))
        sent: set[int] = set()
        for batch in batches:
            own, blobs = [], []
            for text in batch.column("text"):
                shingles = shingle_set(text.as_py())
                number = digest(shingles.tobytes())
                at = number >> shift
                if len(shingles) and bits[at >> 3] >> (at & 7) & 1 and number not in sent:
                    sent.add(number)
                    own.append(number)
                    blobs.append(shingles.tobytes())
            if len(sent) > 500_000:
                sent.clear()
            yield pa.RecordBatch.from_arrays([longs(np.array(own, np.uint64)), pa.array(blobs, pa.binary())], names=["class_id", "shingles"])

    found = texts.mapInArrow(sets, "class_id bigint, shingles binary")
    return found.groupBy("class_id").agg(F.first("shingles").alias("shingles"))


def verified(candidates: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("set_a"), batch.column("set_b")):
                a, b = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(two.as_buffer(), np.uint64)
                if len(a) > len(b):
                    a, b = b, a
                common = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
                keep.append(100 * common >= 80 * (len(a) + len(b) - common))
            kept = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"])
            yield kept.filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("class_id").alias("a"), F.col("shingles").alias("set_a"))
    two = sets.select(F.col("class_id").alias("b"), F.col("shingles").alias("set_b"))
    return candidates.join(two, "b").join(one, "a").select("a", "b", "set_a", "set_b").mapInArrow(check, "a bigint, b bigint")


def ordered(a: Column, b: Column) -> tuple[Column, Column]:
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def second_round(found: DataFrame, members: DataFrame, labels: DataFrame, done: DataFrame, sets: DataFrame | None = None) -> DataFrame:
    """Links that join classes that the first links leave apart.

    Pairs of ``done`` are left out, as they have been compared.  Without ``sets``, the pairs to compare.
    """
    label = F.coalesce("label", "class_id").alias("label")
    labeled = members.join(labels.withColumnRenamed("node", "class_id"), "class_id", "left").select("group_id", "class_id", label)
    placed = write_once(labeled, "placed")
    large = found.filter("kind = 1").select(F.col("a").alias("token"), F.col("b").alias("group_id"), "spot")
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")

    def buckets(frame: DataFrame, kind: int, token: str, other: Column, side: Column, spot: Column) -> DataFrame:
        number = F.lit(kind).cast("bigint").alias("kind")
        return frame.select(number, F.col(token).alias("token"), other.alias("other"), side.alias("side"), spot.alias("spot"), "class_id", "label")

    dealt = large.join(placed, "group_id")
    unlike = dealt.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("token")
    rows = buckets(dealt.join(unlike, "token", "left_semi"), 0, "token", zero, zero, F.col("spot"))
    # members of groups that are not the group's first class; sizes and prefixes are equal, so every spot is possible
    same = F.lit(None).cast("bigint")
    held = write_once(placed.groupBy("group_id").agg(F.count("*").alias("k"), F.min("label").alias("x"), F.max("label").alias("y")), "held")
    inside = buckets(placed.join(held.filter("k > 1 AND x < y").select("group_id"), "group_id"), 1, "group_id", F.col("group_id"), zero, same)
    # ... and their pairs with members of other groups, only where the two groups hold different labels
    first, second = (held.select(F.col("group_id").alias(n), F.col("k").alias(f"k_{n}"), F.col("x").alias(f"x_{n}"), F.col("y").alias(f"y_{n}")) for n in "ab")
    pairs = found.filter("kind = 0").select("a", "b").distinct().join(first, "a").join(second, "b")
    touched = write_once(pairs.filter("greatest(k_a, k_b) > 1 AND least(x_a, x_b) < greatest(y_a, y_b)").select("a", "b"), "touched")
    sides = [buckets(touched.join(placed.withColumnRenamed("group_id", n), n), 2, "a", F.col("b"), side, same) for n, side in (("a", one), ("b", one + one))]
    every = write_once(rows.union(inside).union(sides[0]).union(sides[1]), "members")
    filled = every.withColumn("shingles", F.lit(None).cast("binary")) if sets is None else every.join(sets, "class_id")
    size = F.coalesce((F.octet_length("shingles") / 8).cast("bigint"), one)
    ready = filled.withColumn("spot", F.coalesce("spot", F.shiftleft(size, 31)))
    return crossed(ready).distinct().join(done, ["a", "b"], "left_anti")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id: components of documents with similar shingle sets.

    ``component_id`` is the smallest doc_id reachable by links.  One row for each
    input row; rows with equal sets are linked, repeated ids included.  A missing
    id never is a component's id unless it has no other.  A missing or empty text
    and one of white space has no shingles and links to nothing, not even to its
    like.  Other columns are ignored.
    """
    texts = texts_of(docs)
    rows = write_once(described(texts, frequencies(texts)), "prefixes")
    filled = rows.filter("n > 0")
    classes = filled.groupBy("class_id", "group_id").agg(F.min("doc_id").alias("least"), F.max("n").alias("n"), F.first("sketch").alias("sketch"))
    classes = write_once(classes, "classes")
    members = classes.filter("length(sketch) > 0").select("class_id", "group_id")  # without a repeated shingle in its prefix, a set has no partner
    groups = filled.filter("length(prefix) > 0").groupBy("group_id", "n").agg(F.first("prefix").alias("prefix"), F.first("places").alias("places"))
    found = write_once(prefix_rows(groups).repartition("token").mapInArrow(_buckets, "kind int, a bigint, b bigint, spot bigint"), "buckets")

    first = members.groupBy("group_id").agg(F.min("class_id").alias("first"), F.count("*").alias("k"))
    one = first.select(F.col("group_id").alias("a"), F.col("first").alias("x"))
    two = first.select(F.col("group_id").alias("b"), F.col("first").alias("y"))
    between = found.filter("kind = 0").select("a", "b").distinct().join(one, "a").join(two, "b").select(*ordered(F.col("x"), F.col("y")))
    inside = members.join(first.filter("k > 1"), "group_id").filter("class_id != first").select(*ordered(F.col("first"), F.col("class_id")))
    candidates = write_once(sketched(between.union(inside).distinct(), classes), "candidates")

    several = found.filter("kind = 1").select(F.col("b").alias("group_id")).union(first.filter("k > 1").select("group_id"))
    k_one, k_two = (first.filter("k > 1").select(F.col("group_id").alias(n)) for n in "ab")
    met = found.filter("kind = 0").select("a", "b")  # groups of one class met by one of several
    single = met.join(k_one, "a", "left_semi").select(F.col("b").alias("group_id")).union(met.join(k_two, "b", "left_semi").select(F.col("a").alias("group_id")))
    later = members.join(several.union(single).distinct(), "group_id", "left_semi").select("class_id")
    needed = candidates.select(F.explode(F.array("a", "b")).alias("class_id")).union(later).distinct()
    sets = write_once(sets_of(texts, write_once(needed, "needed")), "sets")
    links = write_once(verified(candidates, sets), "first-links")
    labels = connected(links)
    more = write_once(second_round(found, members, labels, candidates, sets), "second-links")
    labeled = classes.join(labels.withColumnRenamed("node", "class_id"), "class_id", "left")
    labeled = labeled.select("class_id", "least", F.coalesce("label", "class_id").alias("label"))
    if not more.isEmpty():
        labeled = write_once(labeled, "first-labels")
        joined = more
        for n in "ab":  # links of components
            joined = joined.join(labeled.select(F.col("class_id").alias(n), F.col("label").alias(f"label_{n}")), n)
        roots = connected(joined.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")))
        merged = labeled.join(roots.select(F.col("node").alias("label"), F.col("label").alias("root")), "label", "left")
        labeled = merged.select("class_id", "least", F.coalesce("root", "label").alias("label"))
    least = labeled.groupBy("label").agg(F.min("least").alias("component_id"))
    by_class = labeled.join(least, "label").select("class_id", "component_id")
    joined = rows.select("doc_id", "n", "class_id").join(by_class, "class_id", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
