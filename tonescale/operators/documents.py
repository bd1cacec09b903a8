"""From raw documents to unique, cleaned and tokenized ones."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonescale.functions.text import (
    clean_text,
    has_token,
    is_blank,
    text_key,
    text_or_missing,
    tokenize,
)


def fill_missing_text(docs: DataFrame, null_policy: str = "nan") -> DataFrame:
    """Missing texts become the word ``nan`` (default) or are dropped."""
    if null_policy == "drop":
        return docs.filter(F.col("text").isNotNull()).withColumn("text", F.col("text").cast("string"))
    if null_policy != "nan":
        raise ValueError(f"unknown null_policy: {null_policy}")
    return docs.withColumn("text", text_or_missing(F.col("text")))


def drop_blank(docs: DataFrame) -> DataFrame:
    return docs.filter(~is_blank(F.col("text")))


def first_copies(
    keyed: DataFrame,
    same_in_copies: Iterable[str] = (),
    of_first: Iterable[str] = (),
) -> DataFrame:
    """One row per ``text_key``: the lowest ``doc_id`` and the named columns.

    ``same_in_copies`` are functions of the text, equal in all copies;
    ``of_first`` are taken from the row with the lowest id, of rows with equal
    ids from the one with the least values.  Copies are merged before the
    shuffle, so a text that makes up a third of the corpus sends one row per
    input task.  Ids may repeat; a missing one counts as the highest.
    """
    return keyed_copies(keyed, same_in_copies, of_first).drop("text_key")


def keyed_copies(keyed: DataFrame, same_in_copies: Iterable[str] = (), of_first: Iterable[str] = ()) -> DataFrame:
    """As ``first_copies``, with the ``text_key``."""
    of_first = list(of_first)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("_missing"), "doc_id", *of_first))
    merged = keyed.groupBy("text_key").agg(
        F.min("doc_id").alias("doc_id"),
        *[F.max(name).alias(name) for name in same_in_copies],
        *[least.alias("_first")] * bool(of_first),
    )
    taken = [F.col("_first")[name].alias(name) for name in of_first]
    return merged.select("text_key", "doc_id", *same_in_copies, *taken)


def ids_are_unique(docs: DataFrame) -> bool:
    """Whether every row has an id of its own; runs one job over the ids."""
    return docs.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL").isEmpty()


def drop_duplicates(docs: DataFrame, unique: bool | None = None) -> DataFrame:
    """Keep, of every set of equal raw texts, the row with the lowest ``doc_id``.

    The groups are built on digests and ids only.  With unique ids the texts
    then meet the surviving ids in a semi-join on the id, which is free of
    skew, and hashing the ids (a small part of each partition's text) spares
    sorting the texts.  Later steps by ``doc_id`` reuse this partitioning.

    Where ids repeat or are missing (``unique``, checked if not given),
    survivors are keyed by digest and id, and rows equal in both become one.
    A missing id counts as the highest.
    """
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("text_key"))
    if ids_are_unique(docs) if unique is None else unique:
        return docs.join(first_copies(keyed).hint("shuffle_hash"), "doc_id", "left_semi")
    # Equal rows merge in their tasks first, so no text or missing id is hot.
    rest = [name for name in docs.columns if name not in ("doc_id", "text")]
    once = docs.withColumn("text_key", text_key(F.col("text"))).groupBy("text_key", "doc_id").agg(
        F.min(F.struct("text", *rest)).alias("_row")
    )
    survivors = keyed_copies(keyed).withColumnRenamed("doc_id", "_first")
    kept = once.join(
        survivors,
        (once["text_key"] == survivors["text_key"]) & once["doc_id"].eqNullSafe(survivors["_first"]),
        "left_semi",
    )
    return kept.select(*["doc_id" if name == "doc_id" else F.col("_row")[name].alias(name) for name in docs.columns])


def clean_documents(docs: DataFrame, null_policy: str = "nan") -> DataFrame:
    """Add ``cleaned_text``, ``tokens`` and ``token_count``; drop empty documents.

    Stateless: the frame may be a stream.
    """
    return (
        fill_missing_text(docs, null_policy)
        .filter(has_token(F.col("text")))
        .withColumn("cleaned_text", clean_text(F.col("text")))
        .withColumn("tokens", tokenize(F.col("cleaned_text")))
        .withColumn("token_count", F.size("tokens"))
    )


def unique_documents(docs: DataFrame, null_policy: str = "nan") -> DataFrame:
    """Non-blank documents without repeated texts."""
    return drop_duplicates(drop_blank(fill_missing_text(docs, null_policy)), ids_are_unique(docs))


def prepare_documents(docs: DataFrame, null_policy: str = "nan") -> DataFrame:
    """Unique documents, cleaned and tokenized.

    Copies agree on having tokens, so empty documents leave before the dedup.
    """
    filled = fill_missing_text(docs, null_policy).filter(has_token(F.col("text")))
    return clean_documents(drop_duplicates(filled, ids_are_unique(docs)), null_policy)


def preprocess_counters(docs: DataFrame, null_policy: str = "nan") -> DataFrame:
    """Rows in, blanks, duplicates and empty documents removed, rows out.

    One pass: all counts follow from the number of copies of each text.
    """
    text = F.col("text")
    per_text = (
        fill_missing_text(docs, null_policy)
        .select(
            text_key(text).alias("text_key"),
            is_blank(text).alias("blank"),
            has_token(text).alias("full"),
        )
        .groupBy("text_key", "blank", "full")
        .agg(F.count(F.lit(1)).alias("copies"))
    )

    def total(value, condition):
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0).cast("bigint"))

    blank, full, copies = F.col("blank"), F.col("full"), F.col("copies")
    return per_text.agg(
        total(copies, F.lit(True)).alias("rows_in"),
        total(copies, blank).alias("blank_removed"),
        total(copies - 1, ~blank).alias("duplicates_removed"),
        F.count_if(~blank & ~full).alias("empty_removed"),
        F.count_if(full).alias("rows_out"),
    )


def preview_documents(docs: DataFrame, rows: int = 5, null_policy: str = "nan") -> DataFrame:
    """The first prepared documents.

    The choice runs on ids; only the chosen rows (``rows`` of them) meet their
    texts, so the corpus texts are not shuffled.
    """
    filled = fill_missing_text(docs, null_policy).filter(has_token(F.col("text")))
    keyed = filled.select("doc_id", text_key(F.col("text")).alias("text_key"))
    chosen = keyed_copies(keyed).orderBy(F.asc_nulls_last("doc_id"), "text_key").limit(rows)
    first = F.broadcast(chosen.withColumnRenamed("doc_id", "_first"))
    same = (text_key(filled["text"]) == first["text_key"]) & filled["doc_id"].eqNullSafe(first["_first"])
    found = filled.join(first, same, "left_semi")
    return clean_documents(drop_duplicates(found, unique=False), null_policy)
