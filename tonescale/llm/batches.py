"""Small helpers for Arrow batches in Python tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_BATCH = 1000
DEFAULT_ROWS = "10000"


def bound_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of 1,000 rows, unless the session says otherwise.

    Spark's default of 10,000 rows suits narrow rows; long texts need less so
    that a Python worker holds a few MB at a time.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, DEFAULT_ROWS) == DEFAULT_ROWS:
        spark.conf.set(name, str(ROWS_PER_BATCH))


def texts_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and text alone; a missing text is the empty one."""
    bound_batches(docs.sparkSession)
    return docs.select(
        F.col(key).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )


def pairs(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows of a batch as tuples, one text decoded at a time."""
    return zip(*(iter_values(column) for column in batch.columns))


def iter_values(column: pa.Array) -> Iterator:
    return (value.as_py() for value in column)
