"""Document readers: labeled CSV, JSON, JSON lines, plain lines, Parquet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonescale.functions.text import strip
from tonescale.operators.numbering import LOCATION
from tonescale.schemas import RAW_DOCUMENT
from tonescale.sources.quoted_csv import read_records

# Column names that hold document text, in order of preference.
TEXT_COLUMNS = (
    "text",
    "review",
    "sentence",
    "headline",
    "tweet",
    "content",
    "body",
    "message",
    "document",
    "news",
)

# Field contents that the optional NA parsing of CSV takes for
# missing (the defaults of pandas.read_csv).
NA_LITERALS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

CSV_ENCODING = "ISO-8859-1"
FORMATS = ("csv", "json", "jsonl", "txt", "parquet")


def read_csv(
    spark: SparkSession,
    path: str,
    encoding: str = CSV_ENCODING,
    multi_line: bool = True,
    pandas_na: bool = False,
    splits: bool = True,
    located: bool = False,
) -> DataFrame:
    """Headerless ``label,text`` file with doubled quotes.

    ``multi_line`` allows line breaks inside quotes.  Such files are read in
    splits, which takes a second look at the quotes; there, a field that has
    quotes must be quoted as a whole, and fields keep their line breaks as they
    are.  ``splits=False`` reads a file as one split, in any encoding.  A row with
    more or fewer fields is an error.  ``located`` adds where a row begins (the
    columns of ``numbering.LOCATION``), by which ``assign_doc_ids`` numbers rows.
    """
    options = {"escape": '"', "mode": "FAILFAST"}
    if multi_line and splits:
        row = F.from_csv("record", RAW_DOCUMENT, {**options, "multiLine": "true"})
        docs = read_records(spark, path, encoding).select(row.alias("row"), *LOCATION).select("row.*", *LOCATION)
    else:
        docs = spark.read.schema(RAW_DOCUMENT).csv(path, encoding=encoding, header=False, multiLine=multi_line, **options)
        if located:
            place = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()]
            docs = docs.select("label", "text", *[c.alias(n) for c, n in zip(place, LOCATION)])
    if pandas_na:
        docs = docs.withColumns({c: F.when(~F.col(c).isin(*NA_LITERALS), F.col(c)) for c in ("label", "text")})
    return docs if located else docs.select("label", "text")


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON file: a list of records, or one object of equally long columns.

    Without a schema the columns are inferred, which reads the input once more.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    frame = reader.json(path, multiLine=True, mode="FAILFAST")
    return _columns_to_rows(frame)


def _columns_to_rows(frame: DataFrame) -> DataFrame:
    """Turn ``{"text": [..], "label": [..]}`` into rows; records pass unchanged."""
    kinds = {field.name: field.dataType for field in frame.schema.fields}
    text = resolve_text_column(frame, only_named=True)
    if text is None:
        return frame
    if isinstance(kinds[text], T.StructType):
        raise ValueError(
            f"column '{text}' is an object keyed by row index; "
            "store the file as a list of records or as columns of arrays"
        )
    if not isinstance(kinds[text], T.ArrayType):
        return frame
    lists = {name: kind for name, kind in kinds.items() if isinstance(kind, T.ArrayType)}
    sizes = [F.coalesce(F.size(name), F.lit(-1)) for name in lists]
    unequal = F.lit(False)
    for size in sizes[1:]:
        unequal = unequal | (size != sizes[0])
    zipped = F.arrays_zip(*lists)
    checked = F.when(unequal, F.raise_error(F.lit("columns of unequal length")).cast(_zip_type(lists))).otherwise(zipped)
    scalars = [name for name in kinds if name not in lists]  # the same for every row
    return frame.select(*scalars, F.inline(checked))


def _zip_type(kinds: dict[str, T.DataType]) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(name, kind.elementType) for name, kind in kinds.items()]))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines; blank lines are skipped, a malformed line is an error."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(path, mode="FAILFAST")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One stripped, non-blank line per document, in column ``text``."""
    lines = spark.read.text(path).select(strip(F.col("value")).alias("text"))
    return lines.filter(F.col("text") != "")


def resolve_text_column(docs: DataFrame, only_named: bool = False) -> str | None:
    """Name of the text column: a known name in any case, else the first string column."""
    by_lower = {name.lower(): name for name in docs.columns}
    for candidate in TEXT_COLUMNS:
        if candidate in by_lower:
            return by_lower[candidate]
    if only_named:
        return None
    for field in docs.schema.fields:
        if isinstance(field.dataType, T.StringType):
            return field.name
    raise ValueError("no text column found")


def with_text_column(docs: DataFrame, text_column: str | None = None) -> DataFrame:
    """Rename the given or detected text column to ``text``."""
    name = text_column if text_column is not None else resolve_text_column(docs)
    if name not in docs.columns:
        raise ValueError(f"column '{name}' not found")
    return docs.withColumnRenamed(name, "text")


def _format_of(path: str) -> str:
    leaf = path.rstrip("/").rsplit("/", 1)[-1]
    return leaf.rsplit(".", 1)[-1].lower() if "." in leaf else ""


def load_documents(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    text_column: str | None = None,
    **options,
) -> DataFrame:
    """Read documents in the format named by ``fmt`` or the path's suffix.

    Options go to the reader of that format.  The result has a column ``text``.
    """
    fmt = fmt or _format_of(path)
    if fmt not in FORMATS:
        raise ValueError(f"unsupported file format: {fmt or path}")
    try:
        if fmt == "csv":
            docs = read_csv(spark, path, **options)
        elif fmt == "json":
            docs = read_json(spark, path, **options)
        elif fmt == "jsonl":
            docs = read_jsonl(spark, path, **options)
        elif fmt == "txt":
            docs = read_lines(spark, path)
        else:
            docs = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"file not found: {path}") from error
        raise
    return with_text_column(docs, text_column)
