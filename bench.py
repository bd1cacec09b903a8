"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local cores.
After a few warm-up runs of the first query, every query runs once untimed and
then twice; the faster time counts.
``score_and_reduce`` has the scope of the published baseline: scoring and
reduction of documents already tokenized and in memory.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tonescale.operators.documents import prepare_documents
from tonescale.operators.scoring import score_documents
from tonescale.operators.summaries import summarize
from tonescale.plans import inputs
from tonescale.plans.queries import QUERIES
from tonescale.runtime import local_session

HEADLINES = (
    "sentiment_summary",
    "dedup_documents",
    "clean_documents",
    "tokenize_documents",
    "preprocess_counters",
    "vocabulary",
    "top_words",
    "corpus_summary",
    "lexicon_hits",
    "scored_documents",
    "scored_documents_join",
    "scored_documents_shuffled",
    "reducer_summary",
    "chunk_summary",
    "merged_summary",
    "sentiment_by_lang",
    "reconcile_scores",
    "validated_predictions",
    "confusion_matrix",
    "class_metrics",
    "metrics_summary",
    "csv_documents",
    "jsonl_documents",
)
REPEATS = 2
WARM_UPS = 3


def consume(frame: DataFrame) -> None:
    """Compute every row and column without keeping them."""
    frame.write.format("noop").mode("overwrite").save()


def best_time(run: Callable[[], None]) -> float:
    run()
    times = []
    for _ in range(REPEATS):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(min(times), 4)


def score_and_reduce(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    tokens = prepare_documents(inputs.documents(spark, sf_dir)).select("doc_id", "tokens").persist()
    lexicon = inputs.test_lexicon(spark)
    totals = tokens.selectExpr("count(*) AS docs", "sum(size(tokens)) AS tokens").first()
    score = score_documents(lexicon, fold=False)
    seconds = best_time(lambda: consume(summarize(tokens.transform(score))))
    tokens.unpersist()
    return {
        "seconds": seconds,
        "documents_per_second": round(totals.docs / seconds),
        "tokens_per_second": round(totals.tokens / seconds),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    chosen = names.split(",") if names else HEADLINES
    for _ in range(WARM_UPS):
        consume(QUERIES[chosen[0]](spark, sf_dir))
    times = {name: best_time(lambda q=QUERIES[name]: consume(q(spark, sf_dir))) for name in chosen}
    baseline_scope = score_and_reduce(spark, sf_dir)
    times["score_and_reduce"] = baseline_scope.pop("seconds")
    result = {
        "metric": "total time of the headline queries",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "score_and_reduce_throughput": baseline_scope,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
