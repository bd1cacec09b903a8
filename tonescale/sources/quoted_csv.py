"""CSV with line breaks inside quotes, read in splits.

A line break belongs to a field when an odd number of quotes precedes it (doubled
quotes count twice, so they do not matter).  One pass counts the quotes of every
split; their running parity in a file tells which splits begin inside quotes.  A
second pass glues the lines of a split to records.  Only what a split's edge cuts,
two pieces a split at most, is shuffled to be put together.

Lines are handled as bytes and decoded as whole records, so no encoding in which
quotes and line breaks are single bytes is harmed by the cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Encodings in which a quote or a line break is one byte that is part of nothing else.
BYTE_ENCODINGS = ("UTF-8", "ISO-8859-1", "US-ASCII")

# A piece of a record: all of it, its first part in a split, its last, or lines of which neither end is here.
WHOLE, OPENED, CLOSED, INSIDE = range(4)
PIECES = "_path string, _start bigint, _running bigint, kind int, record binary"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The bytes of every line with its file and the offset of its split, in the order of the split."""
    text = spark.read.option("lineSep", "\n").text(path)
    place = [F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start")]
    return text.select(F.col("value").cast("binary").alias("line"), *place)


def _begins_inside(spark: SparkSession, path: str) -> DataFrame:
    """The splits that begin inside quotes; one short row each."""
    text = spark.read.option("lineSep", "\n").text(path)
    quotes = F.octet_length("value") - F.octet_length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    counted = text.groupBy(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start")).agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    inside = counted.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    return inside.filter("inside").select("_path", "_start", "inside")


class _Split:
    """Glues the lines of one split, handed over in order."""

    def __init__(self, path: str, start: int, inside: bool):
        self.path, self.start, self.inside = path, start, inside
        self.held: list[bytes] = []  # lines of a record that is not complete
        self.cut = inside  # whether its first line is in an earlier split
        self.number = 0

    def _rows(self, kind: int, records: pa.Array | list[bytes]) -> pa.RecordBatch:
        n = len(records)
        # A record is numbered where it begins; other pieces take the number of none.
        numbers = np.arange(self.number, self.number + n) if kind in (WHOLE, OPENED) else np.full(n, -1)
        self.number += n if kind in (WHOLE, OPENED) else 0
        columns = [pa.array([self.path] * n, pa.string()), pa.array(np.full(n, self.start)), pa.array(numbers), pa.array(np.full(n, kind, np.int32))]
        return pa.RecordBatch.from_arrays([*columns, pa.array(records, pa.binary())], names=[c.split()[0] for c in PIECES.split(", ")])

    def add(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        odd = pc.count_substring(lines, '"').to_numpy() % 2 == 1
        if not self.inside and not odd.any():  # the common case: every line is a record
            yield self._rows(WHOLE, lines)
            return
        open_after = np.logical_xor.accumulate(np.r_[self.inside, odd])[1:]
        ends = np.flatnonzero(~open_after)
        start, records = 0, []
        for end in ends.tolist():
            piece = [*self.held, *lines[start : end + 1].to_pylist()]
            self.held, start = [], end + 1
            if self.cut:
                yield self._rows(CLOSED, [b"\n".join(piece)])
                self.cut = False
            else:
                records.append(b"\n".join(piece))
        if records:
            yield self._rows(WHOLE, records)
        self.held += lines[start:].to_pylist()
        self.inside = bool(open_after[-1])

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield self._rows(INSIDE if self.cut else OPENED, [b"\n".join(self.held)])


def _glue(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    split = None
    for batch in batches:
        paths = batch.column("_path").dictionary_encode()
        at = np.stack([paths.indices.to_numpy(), batch.column("_start").to_numpy()])
        edges = [0, *(np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for first, last in zip(edges, edges[1:]):
            if first == last:
                continue
            path, start = batch.column("_path")[first].as_py(), int(at[1, first])
            if split is None or (split.path, split.start) != (path, start):
                if split is not None:
                    yield from split.end()
                split = _Split(path, start, bool(batch.column("inside")[first].as_py()))
            yield from split.add(batch.column("line")[first:last])
    if split is not None:
        yield from split.end()


def read_records(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """``record``: the text of every CSV record, and where it begins (columns of ``numbering.LOCATION``).

    Blank records are left out.  A carriage return that ends a record is not part of it.
    """
    if encoding.upper() not in BYTE_ENCODINGS:
        raise ValueError(f"encoding without single-byte quotes and line breaks: {encoding}; use splits=False")
    # One row of a path and a number per split (128 MB) that begins inside quotes.
    inside = F.broadcast(_begins_inside(spark, path))
    lines = _lines(spark, path).join(inside, ["_path", "_start"], "left").select("line", "_path", "_start", "inside")
    pieces = lines.mapInArrow(_glue, PIECES)
    # A record's pieces: the one that opens it, and those up to the next that does.
    order = Window.partitionBy("_path").orderBy("_start", F.col("kind") == OPENED)
    cut = pieces.filter(F.col("kind") != WHOLE).withColumn("opened", F.sum(F.when(F.col("kind") == OPENED, 1).otherwise(0)).over(order))
    parts = F.array_sort(F.collect_list(F.struct("_start", (F.col("kind") == OPENED).alias("last"), "_running", "record")))
    glued = cut.groupBy("_path", "opened").agg(parts.alias("parts")).select(
        "_path", F.col("parts")[0]["_start"].alias("_start"), F.col("parts")[0]["_running"].alias("_running"),
        F.array_join(F.transform("parts", lambda p: F.hex(p["record"])), "0A").alias("joined"),
    )
    whole = pieces.filter(F.col("kind") == WHOLE).select("_path", "_start", "_running", "record")
    records = whole.union(glued.select("_path", "_start", "_running", F.unhex("joined").alias("record")))
    text = F.col("record").cast("string") if encoding.upper() == "UTF-8" else F.decode("record", encoding)
    trimmed = F.regexp_replace(text, r"\r$", "")
    return records.select("_path", "_start", "_running", trimmed.alias("record")).filter(F.col("record") != "")
