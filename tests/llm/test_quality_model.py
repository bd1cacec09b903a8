"""Labellers on planted votes, the scorer on held-out labels."""

import random
import re

import numpy as np
import pytest

from tonescale.llm.quality_model import BAD, GOOD, INSULTS, LABELLERS, NONE, Labellers, classified, features, good_labels, votes


def test_accuracies_of_planted_votes():
    rng = random.Random(1)
    wanted = [0.94, 0.9, 0.85, 0.8, 0.9, 0.93, 0.7, 0.9, 0.85, 0.9, 0.8, 0.92]
    counts = {}
    for _ in range(20_000):
        truth = rng.random() < 0.5
        codes = "".join(str(NONE if rng.random() < 0.3 else GOOD if truth == (rng.random() < a) else BAD) for a in wanted)
        counts[codes] = counts.get(codes, 0) + 1
    assert np.abs(Labellers(sorted(counts.items())).accuracy - wanted).max() < 0.03


def test_empty_and_odd_texts():
    for text in ("", " \n", "a", "🙂" * 1000, "x " * 100_000, "\x00 ퟿"):
        assert len(votes(text)) == LABELLERS
        at, values = features(text)
        assert len(at) == len(values) and np.isfinite(values).all()


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.1"])
def test_held_out_labels(spark, folder):
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    found = classified(docs, good_labels(labels.filter("doc_id % 5 != 0"))).join(labels.filter("doc_id % 5 = 0"), "doc_id")
    rows = found.select("accepted", "text", "quality", "toxic").collect()
    clean = [r.accepted for r in rows if r.quality == 1 and r.toxic == 0]
    # a toxic label without any insult in the text is noise in this table
    rest = [r.accepted for r in rows if r.quality == 0 or r.toxic == 1 and INSULTS & set(re.findall("[a-z]+", r.text.lower()))]
    assert sum(clean) >= 0.99 * len(clean) and sum(rest) <= 0.02 * len(rest), (sum(clean), len(clean), sum(rest), len(rest))


def test_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (None, "the plain text of it", "y"), (2, "", "z"), (2, "", "z")], "doc_id bigint, text string, accepted string")
    rows = classified(docs).collect()
    assert len(rows) == 4 and all(0 <= r.quality_score <= 1 for r in rows)
    assert classified(docs.limit(0)).count() == 0
