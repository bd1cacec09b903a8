"""What five filters remove, alone and together, counted over a stream of files.

Every file of the corpus passes as part of an available-now micro-batch.  Four
filters judge a text by itself; the fifth (E) fails a copy of a text that a
smaller id has.  So a text's state is the smallest id seen, with the rows that
hold it, kept in buckets of texts.  When a smaller id arrives, the rows counted as first copies are
retracted from the part counters and counted again as copies.

A counter is (part, mask): rows, good and toxic rows by the set of filters that
they fail.  All 120 orders of the filters follow from these 32 numbers a part.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tonescale.functions.text import text_key
from tonescale.llm.batches import pairs
from tonescale.runtime import scratch_path

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
#: Micro-batches that a run takes at most; their size follows the number of files.
BATCHES = 4
#: Texts that a task merges before it hands them on, and rows to a bucket of texts.
MERGED, BUCKET = 100_000, 512

DELTAS = "part string, mask int, n bigint, good bigint, toxic bigint"
MERGED_ROWS = "text_key binary, part string, mask int, least bigint, n_least bigint, good_least bigint, toxic_least bigint, n bigint, good bigint, toxic bigint"
MERGED_NAMES = [column.split()[0] for column in MERGED_ROWS.split(", ")]
STATE = "texts binary"
STATE_TYPES = (pa.binary(), pa.int64(), pa.string(), *[pa.int64()] * 3)

# State lives in RocksDB: on disk, with a bounded share of memory, its changes saved with every batch.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Stores would reserve 4 MB of disk each for a few KB of lists of files.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "300",
}


def failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    upper = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    failed = (
        F.size(words) < 100,
        F.size(F.array_distinct(words)) * 100 < F.size(words) * 80,
        upper.cast("bigint") * 100 > F.length(text).cast("bigint") * 10,
        text.rlike(r"[#$%&*|]"),
    )
    mask = F.lit(0)
    for bit, fails in enumerate(failed):
        mask = mask + F.when(fails, 1 << bit).otherwise(0)
    return mask


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text_key, part, mask, good, toxic of every row.

    Only these narrow rows meet the labels.  Rows without id are spread by their
    place in their file (``row``), as they match no label.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    part = F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part")
    spread = F.when(F.col("doc_id").isNull(), F.col("row")).alias("spread")
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key(text).alias("text_key"), part, failures(text).alias("mask"), spread)
    marks = labels.groupBy(F.col("doc_id").cast("bigint").alias("label_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("bad"),
    )
    marks = marks.filter("label_id IS NOT NULL AND good + bad > 0").withColumn("label_spread", F.lit(None).cast("bigint"))
    same = (F.col("doc_id") == F.col("label_id")) & F.col("spread").eqNullSafe(F.col("label_spread"))
    number = [F.coalesce(c, F.lit(0)).cast("bigint").alias(n) for c, n in ((F.col("good"), "good"), (F.col("bad"), "toxic"))]
    return narrow.join(marks, same, "left").select("doc_id", "text_key", "part", "mask", *number)


def merge_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one text and part as one: all of them, and those of the least id."""
    held: dict[tuple, list] = {}

    def rows() -> pa.RecordBatch:
        columns = zip(*((*key[:3], *value) for key, value in held.items()))
        types = (pa.binary(), pa.string(), pa.int32(), *[pa.int64()] * 7)
        found = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=MERGED_NAMES)
        held.clear()
        return found

    for batch in batches:
        for doc_id, key, part, mask, good, toxic in pairs(batch):
            own = held.setdefault((key, part, mask, doc_id is None), [doc_id, 0, 0, 0, 0, 0, 0])
            own[4:] = own[4] + 1, own[5] + good, own[6] + toxic
            if doc_id is not None and doc_id < own[0]:
                own[:4] = doc_id, 1, good, toxic
            elif doc_id == own[0]:
                own[1:4] = own[1] + 1, own[2] + good, own[3] + toxic
        if len(held) > MERGED:
            yield rows()
    if held:
        yield rows()


Held = dict[bytes, tuple[int, dict[str, list[int]]]]


def packed(held: Held) -> bytes:
    """The texts of a bucket: key, least id, and by part the rows that hold it."""
    rows = [(key, least, part, *counts) for key, (least, first) in held.items() for part, counts in first.items()]
    table = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), STATE_TYPES)], names=list("klpngt"))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_batch(table)
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> Held:
    held: Held = {}
    table = pa.ipc.open_stream(data).read_all()
    for key, least, part, *counts in zip(*(column.to_pylist() for column in table.columns)):
        held.setdefault(key, (least, {}))[1][part] = counts
    return held


def change(held: Held, sums: dict[tuple, list[int]], row: tuple) -> None:
    """Take the merged rows of a text into its state and the changes of the counters."""
    key, part, mask, own, *counts = row
    least_counts, counts = counts[:3], counts[3:]

    def add(part: str, mask: int, numbers: list[int], sign: int = 1) -> None:
        total = sums.setdefault((part, mask), [0, 0, 0])
        total[:] = [a + sign * b for a, b in zip(total, numbers)]

    if own is None:  # without id: no copy of another, and no original
        add(part, mask, counts)
        return
    if key not in held or own < held[key][0]:
        for before, numbers in held.get(key, (own, {}))[1].items():
            add(before, mask, numbers, -1)
            add(before, mask | COPY, numbers)
        held[key] = own, {}
    least, first = held[key]
    if own == least:
        first[part] = [a + b for a, b in zip(first.get(part, (0, 0, 0)), least_counts)]
        add(part, mask, least_counts)
        counts = [a - b for a, b in zip(counts, least_counts)]
    add(part, mask | COPY, counts)


def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    held = unpacked(state.get[0]) if state.exists else {}
    sums: dict[tuple, list[int]] = {}
    for frame in frames:
        keys, parts, masks, ids, *counts = (frame[name].tolist() for name in MERGED_NAMES)
        for row in zip(keys, parts, masks, (None if i is None else int(i) for i in ids), *counts):
            change(held, sums, row)
    if held:
        state.update((packed(held),))
    yield pd.DataFrame([(*at, *numbers) for at, numbers in sums.items()], columns=["part", "mask", "n", "good", "toxic"])


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def part_counters(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    """part, mask and the numbers of rows, good and toxic ones, after all files of ``path``.

    Each batch stores its changes in a folder of its own, which a replay
    overwrites; counters are their sums.  The state of a few hundred texts makes
    one value of the store, as a call of Python for each text would cost more
    than the text; the number of such buckets follows the number of rows.
    """
    whole = spark.read.parquet(path)
    files = len(whole.inputFiles())
    # A pattern that fits this name alone: a stream takes a plain path for a folder.
    pattern = f"{path[:-1]}[{path[-1]}]"
    docs = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", max(1, -(-files // batches))).parquet(pattern)
    docs = docs.select("doc_id", "text", "lang", F.col("_metadata.row_index").alias("row"))
    rows = judged(docs, labels).mapInArrow(merge_copies, MERGED_ROWS)
    # An id beside missing ones would turn into a float in pandas: as text it stays whole.
    rows = rows.withColumn("least", F.col("least").cast("string"))
    buckets = F.lit(whole.count() // BUCKET + 1)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("text_key"), buckets))
    changes = rows.groupBy("bucket").applyInPandasWithState(update, DELTAS, STATE, "append", GroupStateTimeout.NoTimeout)
    out, progress = scratch_path(spark, "audit-counters"), scratch_path(spark, "audit-progress")
    spark.createDataFrame([], DELTAS).write.parquet(f"{out}/batch=-1")

    def store(batch: DataFrame, number: int) -> None:
        sums = [F.sum(name).alias(name) for name in ("n", "good", "toxic")]
        batch.groupBy("part", "mask").agg(*sums).write.mode("overwrite").parquet(f"{out}/batch={number}")

    with settings(spark, STATE_CONF):
        writer = changes.writeStream.foreachBatch(store).option("checkpointLocation", progress)
        writer.trigger(availableNow=True).start().awaitTermination()
    counters = spark.read.schema(DELTAS + ", batch bigint").parquet(out).groupBy("part", "mask")
    return counters.agg(*[F.sum(name).cast("bigint").alias(name) for name in ("n", "good", "toxic")])


def interactions(counters: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    orders = F.explode(F.array(*[F.lit("".join(order)) for order in itertools.permutations(FILTERS)]))
    steps = counters.withColumn("filter_order", orders).select("*", F.posexplode(F.split("filter_order", "")).alias("_at", "_filter"))
    bit, before = F.lit(0), F.lit(0)
    for i, name in enumerate(FILTERS):
        bit = bit + F.when(F.col("_filter") == name, 1 << i).otherwise(0)
        before = before + F.when(F.instr("filter_order", name) <= F.col("_at"), 1 << i).otherwise(0)
    steps = steps.withColumns({"_bit": bit, "_before": before})
    fails, earlier = F.col("mask").bitwiseAND(F.col("_bit")) != 0, F.col("mask").bitwiseAND(F.col("_before")) != 0
    removed = fails & ~earlier

    def total(name: str, condition: Column) -> Column:
        return F.sum(F.when(condition, F.col(name)).otherwise(0)).cast("bigint")

    found = steps.groupBy("part", "filter_order", (F.col("_at") + 1).alias("step"), "_filter").agg(
        total("n", ~fails & ~earlier).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", fails & earlier).alias("redundant"),
        total("n", F.col("mask") == F.col("_bit")).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
    )
    # 120 rows to a window: the filter's steps in all orders.
    shapley = F.sum("removed").over(Window.partitionBy("part", "_filter")).alias("shapley")
    return found.select("*", shapley).drop("_filter")


def filter_audit(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    """part, filter_order, step and what the step keeps, removes and loses.

    ``path`` is a Parquet table with doc_id, text and lang; other columns are not
    read.  A missing text is the empty one, a missing lang the part of the empty
    name.  A row without id is never a copy and makes no other row one; rows that
    share an id and a text are no copies of each other.  A document is good or
    toxic if any of its label rows says so.  An empty table gives no rows.
    """
    return interactions(part_counters(spark, path, labels, batches))
