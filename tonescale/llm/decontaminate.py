"""Benchmark decontamination by size-partitioned MinHash containment search.

A short test item inside a long document has a tiny Jaccard similarity with it.
So items are partitioned by size, and for each partition a document is cut into
windows of twice the partition's largest size, each starting one such size
after the other: an occurrence lies in one window, and its containment in the
item bounds the Jaccard similarity with the window from below, whatever the
length of the document.  MinHash signatures of windows and items are compared by
single values (bands of one), of which a pair at the bound misses all with a
probability below 10^-6.  Candidates are verified by exact shingle containment
in the whole document.

A window's signature value equals an item's only if the window holds the
shingle with that value, so signatures are computed just for windows that hold
a shingle with one of the items' least values; the candidates are the same.

Items are a query set; they are searched in blocks of ``BLOCK``, so what a task
holds has a bound.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonescale.llm.batches import texts_of
from tonescale.llm.shingles import mix, shingles_of

VALUES, BLOCK, CONTAINMENT = 72, 20_000, 0.8


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of the set under each of the hash functions."""
    return np.array([mix(shingles, seed).min() for seed in SEEDS], np.uint64)


SEEDS = [int(x) for x in mix(np.arange(1, VALUES + 1, dtype=np.uint64))]


class Items:
    """A block of items: sets, size partitions, and least shingles by value."""

    def __init__(self, rows: list[tuple[int, str]], containment: float):
        self.containment = containment
        self.sets: list[tuple[int, np.ndarray]] = []
        by_size: dict[int, list[int]] = defaultdict(list)
        for item_id, text in rows:
            shingles = np.unique(shingles_of(text))
            if len(shingles):
                by_size[math.ceil(math.log2(len(shingles)))].append(len(self.sets))
                self.sets.append((item_id, shingles))
        #: For each partition: its largest size, and the items that have a value, by hash function.
        self.partitions = [(1 << k, self.index(members)) for k, members in sorted(by_size.items())]
        least = [s[np.argmin(mix(s, seed))] for _, s in self.sets for seed in SEEDS]
        self.least = np.unique(np.array(least, np.uint64))

    def index(self, members: list[int]) -> list[dict[int, list[int]]]:
        tables: list[dict[int, list[int]]] = [defaultdict(list) for _ in SEEDS]
        for i in members:
            for table, value in zip(tables, signature(self.sets[i][1])):
                table[int(value)].append(i)
        return tables

    def candidates(self, shingles: np.ndarray) -> set[int]:
        at = np.minimum(np.searchsorted(self.least, shingles), len(self.least) - 1)
        held = np.flatnonzero(self.least[at] == shingles)
        found: set[int] = set()
        if not len(held):
            return found
        for size, tables in self.partitions:
            steps = held // size
            for start in np.unique(np.concatenate([steps, np.maximum(steps - 1, 0)])):
                values = signature(shingles[start * size : (start + 2) * size])
                for table, value in zip(tables, values):
                    found.update(table.get(int(value), ()))
        return found

    def contained(self, text: str) -> list[tuple[int, float]]:
        """(item_id, containment) of the items that the text holds."""
        shingles = shingles_of(text)
        if not len(shingles) or not self.sets:
            return []
        found = self.candidates(shingles)
        if not found:
            return []
        whole, hits = np.unique(shingles), []
        for item_id, item in (self.sets[i] for i in sorted(found)):
            at = np.minimum(np.searchsorted(whole, item), len(whole) - 1)
            share = float((whole[at] == item).mean())
            if share >= self.containment:
                hits.append((item_id, share))
        return hits


def item_blocks(items: DataFrame, key: str, text: str, size: int) -> Iterator[list[tuple[int, str]]]:
    """Distinct items, streamed to the driver and handed out in blocks."""
    block: list[tuple[int, str]] = []
    for row in items.select(F.col(key).cast("bigint"), F.col(text).cast("string")).dropna().distinct().toLocalIterator():
        block.append(tuple(row))
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    containment: float = CONTAINMENT,
    item_key: str = "item_id",
    block: int = BLOCK,
) -> DataFrame:
    """The documents and their hits: the items (item_id, containment) that each whole text holds.

    One row for each row of ``docs``, repeated and missing ids included, with an
    empty list where nothing is found.  Hits are in the order of their item ids.
    Items without id or words are never found; an item of fewer than five words
    counts as one shingle, which only a text of just these words holds.  Other
    columns are kept, except one named ``hits``.
    """
    context = docs.sparkSession.sparkContext
    texts_of(docs)  # bounds the batches
    kept = docs.drop("hits")
    found = []
    for rows in item_blocks(items, item_key, "text", block):
        shared = context.broadcast(Items(rows, containment))

        @F.pandas_udf("array<struct<item_id: bigint, containment: double>>")
        def search(texts, shared=shared):
            return texts.map(lambda t: [{"item_id": i, "containment": c} for i, c in shared.value.contained(t or "")])

        found.append(search(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    none = F.array().cast("array<struct<item_id: bigint, containment: double>>")
    return kept.withColumn("hits", F.array_sort(reduce(F.concat, found, none)))
