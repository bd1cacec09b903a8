"""Stage outputs as Spark tables: JSON lines, CSV or Parquet folders.

Files are written by all tasks at once; nothing is gathered into one file
except rows that are one-row summaries already.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonescale.operators.vocabulary import frequency_order


def _write(frame: DataFrame, path: str, fmt: str, keep_nulls: bool = True) -> None:
    writer = frame.write.mode("errorifexists")
    if fmt == "json":
        writer.json(path, ignoreNullFields=not keep_nulls)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unsupported output format: {fmt}")


def write_csv(frame: DataFrame, path: str, header: bool = True, encoding: str = "UTF-8") -> None:
    """CSV with doubled quotes and untouched spaces; arrays become JSON text."""
    columns = [
        F.to_json(field.name).alias(field.name)
        if field.dataType.typeName() in ("array", "map", "struct")
        else F.col(field.name)
        for field in frame.schema.fields
    ]
    frame.select(*columns).write.mode("errorifexists").csv(
        path,
        header=header,
        encoding=encoding,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def _with_label(prepared: DataFrame, columns: list[str]) -> DataFrame:
    return prepared.select(*columns, *(["label"] if "label" in prepared.columns else []))


def write_cleaned_csv(prepared: DataFrame, path: str) -> None:
    columns = ["doc_id", "text", "cleaned_text", "tokens", "token_count"]
    write_csv(_with_label(prepared, columns), path)


def write_token_records(prepared: DataFrame, path: str, fmt: str = "json") -> None:
    records = prepared.withColumnRenamed("text", "original_text")
    columns = ["doc_id", "original_text", "cleaned_text", "tokens"]
    _write(_with_label(records, columns), path, fmt)


def write_vocabulary(ranked: DataFrame, path: str, fmt: str = "json") -> None:
    """The vocabulary in frequency order, over range-partitioned files."""
    _write(ranked.orderBy(*frequency_order()).select("token", "frequency"), path, fmt)


def write_top_words(ranked: DataFrame, path: str) -> None:
    """The whole vocabulary in frequency order as CSV with a header."""
    write_csv(ranked.orderBy(*frequency_order()).select("token", "frequency"), path)


def write_scored(scored: DataFrame, path: str, fmt: str = "json") -> None:
    """Scored documents or validated predictions, NULL fields kept."""
    _write(scored, path, fmt)


def write_mapper_results(scored: DataFrame, path: str, fmt: str = "json") -> None:
    """Predictions without hit counts; missing labels are left out."""
    names = ("doc_id", "tokens", "predicted_sentiment", "score", "true_label")
    columns = [name for name in names if name in scored.columns]
    _write(scored.select(*columns), path, fmt, keep_nulls=False)


def write_summary(summary: DataFrame, path: str, keep_nulls: bool = True) -> None:
    """A one-row summary; ``keep_nulls=False`` leaves out an unknown accuracy."""
    _write(summary, path, "json", keep_nulls)


def write_partials(partials: DataFrame, path: str, fmt: str = "json") -> None:
    """Per-chunk counts, to be merged later."""
    _write(partials, path, fmt)
