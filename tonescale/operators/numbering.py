"""Row positions, document ids and fixed-size chunks without a global window.

Rows are written once with a running number inside their block (an input split
or a range of sorted keys).  Prefix sums of the block sizes give every block its
offset, and position = offset + number.  Few blocks are summed up by the driver,
many in two levels: ranges of blocks, then blocks of a range.
"""

from __future__ import annotations

import itertools
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonescale.runtime import write_once

# Sizes of so many blocks are summed up by the driver (some 250 bytes each with a path).
DRIVER_BLOCKS = 10_000
# Offsets of so many blocks are broadcast.
BROADCAST_BLOCKS = 500_000

# monotonically_increasing_id: partition number above, row number below bit 33.
_ROW_BITS = 33
_DIGITS = 20

# Where a row was read: file, offset of its split, and a running number in the split.
LOCATION = ("_path", "_start", "_running")


def natural_order(path: Column) -> Column:
    """Sort key of file names in which numbers count as numbers: part-99999 before part-100000."""
    runs = F.regexp_extract_all(path, F.lit(r"(\d+|\D+)"))
    return F.transform(runs, lambda run: F.when(run.rlike(rf"^\d{{1,{_DIGITS}}}$"), F.lpad(run, _DIGITS, "0")).otherwise(run))


def _natural_key(value: object) -> object:
    """As ``natural_order``, for values at the driver."""
    if not isinstance(value, str):
        return value
    runs = re.findall(r"[0-9]+|[^0-9]+", value)
    return [run.zfill(_DIGITS) if run[0] in "0123456789" and len(run) <= _DIGITS else run for run in runs], value


def _offsets_at_driver(sizes: DataFrame, rows: list, block: list[str]) -> DataFrame:
    ordered = sorted(rows, key=lambda r: [_natural_key(r[name]) for name in block])
    before = itertools.accumulate((r["_rows"] for r in ordered), initial=0)
    data = [(*(r[name] for name in block), r["_first"], offset) for r, offset in zip(ordered, before)]
    fields = [*(sizes.schema[name] for name in block), sizes.schema["_first"], T.StructField("_offset", T.LongType())]
    return F.broadcast(sizes.sparkSession.createDataFrame(data, T.StructType(fields)))


def _offsets_by_ranges(sizes: DataFrame, block: list[str]) -> DataFrame:
    """Offsets of many blocks: the sum of the ranges before a block's, and of the blocks before it in its range."""
    strings = {field.name for field in sizes.schema.fields if isinstance(field.dataType, T.StringType)}
    keys = [key for name in block for key in ([natural_order(F.col(name))] if name in strings else []) + [F.col(name)]]
    at = F.monotonically_increasing_id().alias("_at")
    placed = write_once(sizes.repartitionByRange(*keys).sortWithinPartitions(*keys).select("*", at), "blocks")
    placed = placed.withColumn("_range", F.shiftright("_at", _ROW_BITS))
    # One row per range, so at most the number of shuffle partitions.
    totals = sorted(placed.groupBy("_range").agg(F.sum("_rows")).collect())
    before = list(zip((r[0] for r in totals), itertools.accumulate((r[1] for r in totals), initial=0)))
    ranges = placed.sparkSession.createDataFrame(before, "_range bigint, _before bigint")
    inside = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("_inside", F.coalesce(F.sum("_rows").over(inside), F.lit(0)))
    found = placed.join(F.broadcast(ranges), "_range")
    return found.select(*block, "_first", (F.col("_before") + F.col("_inside")).alias("_offset"))


def _with_positions(fixed: DataFrame, block: list[str], running: str, name: str) -> DataFrame:
    """Add 0-based positions to rows whose block and running number are fixed."""
    sizes = fixed.groupBy(*block).agg(F.count(F.lit(1)).alias("_rows"), F.min(running).alias("_first"))
    few = sizes.limit(DRIVER_BLOCKS + 1).collect()
    if len(few) <= DRIVER_BLOCKS:
        offsets = _offsets_at_driver(sizes, few, block)
    else:
        offsets = _offsets_by_ranges(sizes, block)
        if offsets.count() <= BROADCAST_BLOCKS:
            offsets = F.broadcast(offsets)
    numbered = fixed.join(offsets, block)
    return numbered.withColumn(name, F.col("_offset") + F.col(running) - F.col("_first")).drop(
        *block, running, "_first", "_offset"
    )


def with_positions(frame: DataFrame, key: str | list[str], name: str = "position") -> DataFrame:
    """Add the 0-based rank of every row in the order of a unique key.

    The rows are range-partitioned by the key, so pass narrow rows.  They
    are written before sizes are counted, which fixes each row's partition.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ordered = frame.repartitionByRange(*keys).sortWithinPartitions(*keys)
    running = F.monotonically_increasing_id()
    fixed = write_once(ordered.withColumn("_running", running), "positions")
    fixed = fixed.withColumn("_block", F.shiftright("_running", _ROW_BITS))
    return _with_positions(fixed, ["_block"], "_running", name)


def assign_doc_ids(frame: DataFrame) -> DataFrame:
    """Number the rows of a file scan 1..N in file order, as ``doc_id``.

    File order is path, with numbers in names as numbers, then offset of the
    split, then row.  Nothing is sorted or range-partitioned: a split is already
    in order.  The frame must be a file scan, optionally with projections and
    filters, or have the columns of ``LOCATION``, which are taken off.
    """
    if set(LOCATION) <= set(frame.columns):
        located = frame
    else:
        located = frame.withColumns(
            {
                "_path": F.col("_metadata.file_path"),
                "_start": F.col("_metadata.file_block_start"),
                "_running": F.monotonically_increasing_id(),
            }
        )
    fixed = write_once(located, "doc-ids")
    numbered = _with_positions(fixed, ["_path", "_start"], "_running", "doc_id")
    names = [name for name in frame.columns if name not in LOCATION]
    return numbered.select((F.col("doc_id") + 1).alias("doc_id"), *names)


def assign_chunks(frame: DataFrame, chunk_size: int, key: str = "doc_id") -> DataFrame:
    """Add ``chunk_id``: consecutive runs of ``chunk_size`` rows in key order."""
    if chunk_size <= 0:
        raise ValueError("chunk_size must be > 0")
    chunk = F.floor(F.col("_position") / chunk_size).cast("bigint")
    return with_positions(frame, key, "_position").withColumn("chunk_id", chunk).drop("_position")
