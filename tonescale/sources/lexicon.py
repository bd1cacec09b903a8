"""Lexicon reader: a JSON object of word weights, flat or in named blocks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonescale.operators.scoring import lexicon_table, small_lexicon

LOCAL_TERMS = 10_000


def _entries(json: Column, kind: str) -> Column:
    """Position, key and value of a JSON object's members, repeated keys included."""
    return F.posexplode(F.from_json(json, f"map<string,{kind}>"))


def _require_object(source: DataFrame, text: Column) -> None:
    """Every text must be exactly one JSON object: not cut off, not empty, with nothing behind it.

    As the only member of a list it must parse strictly to a list of one object.
    """
    wrapped = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<map<string,string>>", {"mode": "FAILFAST"})
    try:
        wrong = source.filter(F.coalesce(F.size(wrapped) != 1, F.lit(True)) | ~F.ltrim(F.regexp_replace(text, r"\s", " ")).startswith("{")).limit(1).count()
    except Exception as error:  # the parser's own error, at the first malformed text
        raise ValueError("a lexicon must be one JSON object") from error
    if wrong or not source.limit(1).count():
        raise ValueError("a lexicon must be one JSON object")


def parse_lexicon(source: DataFrame) -> DataFrame:
    """Lexicon table from a one-column frame holding JSON text.

    Keys are folded to lower case; of equal keys the last one counts.  A weight
    must be a JSON integer: strings, fractions and booleans are errors.  Either
    all members are blocks of words or all are words.
    """
    text = F.col(source.columns[0])
    _require_object(source, text)
    members = source.select(_entries(text, "string").alias("block_pos", "key", "body"))
    is_block = F.col("body").startswith("{")
    shape = members.agg(
        F.count(F.lit(1)).alias("members"),
        F.count_if(is_block).alias("blocks"),
        F.first(F.when(~is_block | F.col("body").isNull(), F.col("key")), ignorenulls=True).alias("plain"),
    ).first()
    if 0 < shape.blocks < shape.members:
        raise ValueError(f"block '{shape.plain}' must be an object of word weights")

    if shape.blocks:
        blocks = source.select(_entries(text, "string").alias("block_pos", "block", "body"))
        words = blocks.select("block_pos", _entries(F.col("body"), "variant").alias("word_pos", "word", "value"))
    else:
        words = source.select(
            F.lit(0).alias("block_pos"), _entries(text, "variant").alias("word_pos", "word", "value")
        )
    words = words.withColumn("kind", F.schema_of_variant("value"))
    wrong = words.filter(F.coalesce(F.col("kind") != "BIGINT", F.lit(True))).select("word", "kind").first()
    if wrong is not None:
        raise ValueError(f"weight of '{wrong.word}' must be an integer, not {wrong.kind}")
    table = words.groupBy(F.lower("word").alias("token")).agg(
        F.max_by(
            F.variant_get("value", "$", "bigint"), F.struct("block_pos", "word_pos")
        ).alias("weight")
    )
    # A lexicon of ordinary size is parsed once and kept as a local relation.
    weights = small_lexicon(table, LOCAL_TERMS)
    return table if weights is None else lexicon_table(source.sparkSession, weights)


def load_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Read a lexicon file.  Large lexicons are better kept as a table."""
    try:
        source = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"file not found: {path}") from error
        raise
    return parse_lexicon(source)
