"""Readers for the records that scoring and evaluation take as input."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonescale.schemas import CHUNK_PARTIAL, PREDICTION, TOKEN_RECORD


def _read_records(spark: SparkSession, path: str, schema: str, fmt: str) -> DataFrame:
    try:
        if fmt == "parquet":
            return spark.read.schema(schema).parquet(path)
        if fmt == "jsonl":
            return spark.read.schema(schema).json(path, mode="FAILFAST")
        if fmt == "json":
            _require_lists(spark, path)
            return spark.read.schema(schema).json(path, mode="FAILFAST", multiLine=True)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"file not found: {path}") from error
        raise
    raise ValueError(f"unsupported record format: {fmt}")


def _require_lists(spark: SparkSession, path: str) -> None:
    """Every JSON file must start with ``[``: a single object is not a list."""
    others = spark.read.text(path, wholetext=True).filter(~F.col("value").rlike(r"\A\s*\["))
    if others.limit(1).count():
        raise ValueError(f"must contain a list of records: {path}")


def load_token_records(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Token records from JSON lists (``json``), JSON lines or Parquet."""
    return _read_records(spark, path, TOKEN_RECORD, fmt)


def load_partials(spark: SparkSession, path: str, fmt: str = "jsonl") -> DataFrame:
    """Stored per-chunk counts."""
    return _read_records(spark, path, CHUNK_PARTIAL, fmt)


def load_predictions(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Predictions of any scoring stage; absent fields read as NULL."""
    return _read_records(spark, path, PREDICTION, fmt)
