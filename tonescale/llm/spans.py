"""Spans of a text: (start, end, kind), end exclusive, in code points."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonescale.llm.batches import pairs, texts_of

Finder = Callable[[str], list[tuple]]
SPANS = "array<struct<kind: string, start: bigint, end: bigint, score: double>>"


def find_spans(docs: DataFrame, finder: Finder) -> DataFrame:
    """doc_id and the spans that ``finder`` gives for each whole text, in its order."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [{"kind": k, "start": s, "end": e, "score": score} for k, s, e, score in finder(text.as_py())]
                for text in batch.column("text")
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], names=["doc_id", "spans"])

    return texts_of(docs).mapInArrow(run, f"doc_id bigint, spans {SPANS}")


def in_order(spans: list[tuple], kinds: tuple[str, ...]) -> list[tuple]:
    """By start, then by the kinds' order, then by end."""
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2]))


def written(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kinds(kinds: tuple[str, ...]) -> Column:
    return F.filter("spans", lambda s: s["kind"].isin(*kinds))


def count_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")


def digest_columns(found: DataFrame, base: tuple[str, ...]) -> DataFrame:
    """doc_id, a count for each base kind, the digest of the base spans, all spans as text."""
    return found.select(
        "doc_id",
        *(count_of(kind).alias(f"n_{kind}") for kind in base),
        F.sha2(written(of_kinds(base)), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
