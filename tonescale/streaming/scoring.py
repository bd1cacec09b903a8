"""Scoring of arriving documents.

Cleaning and literal scoring keep no state, so a stream takes the batch
transforms as they are.  Each micro-batch plays the part of a chunk: its counts
are stored as a partial and ``merge_partials`` adds them up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tonescale.operators.documents import clean_documents
from tonescale.operators.scoring import score_documents, small_lexicon
from tonescale.operators.summaries import partial_summary


def score_stream(docs: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Scored documents of a stream with ``doc_id`` and ``text``.

    The result is a stream, so the form is one without join: literal, or bucketed
    with a lexicon up to the bound of a broadcast.  ``scored_writer`` takes any size.
    """
    weights = small_lexicon(lexicon)
    form = "bucketed" if weights is None else "literal"
    return clean_documents(docs).transform(score_documents(lexicon, form=form, fold=False))


def scored_writer(docs: DataFrame, lexicon: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Score a stream with a lexicon of any size and store every micro-batch below ``path``.

    As in ``partials_writer``, a replayed batch overwrites its own folder.
    Read the result with ``spark.read.parquet(path)``.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        scored = clean_documents(batch).transform(score_documents(lexicon, fold=False))
        scored.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return docs.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)


def partials_writer(docs: DataFrame, lexicon: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Score a stream and store one partial summary per micro-batch below ``path``.

    A micro-batch is a bounded table, so the lexicon may be of any size.  A
    replayed batch overwrites its own folder, so a restart counts nothing
    twice.  Read the result with ``load_partials(spark, path, "parquet")``.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        scored = clean_documents(batch).transform(score_documents(lexicon, fold=False))
        chunk = scored.withColumn("chunk_id", F.lit(batch_id).cast("bigint"))
        counts = partial_summary(chunk, "chunk_id").drop("chunk_id")
        counts.write.mode("overwrite").parquet(f"{path}/chunk_id={batch_id}")

    return docs.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
