"""The pipeline's stages, each against brute force on its own input."""

import hashlib
import re
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tonescale.llm.quality_model import classified, good_labels
from test_decontaminate import brute as held_items
from test_jaccard_join import brute as components
from test_line_dedup import brute as lines

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(corpus_pipeline.write_once(stage(spark, seen[-1], FOLDER), name))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert seen[-1].columns == docs.columns
    return seen


def texts(frame):
    return sorted((r.doc_id, r.text) for r in frame.select("doc_id", "text").collect())


def test_classifier_keeps_clean_documents(spark, stages):
    kept = {r.doc_id for r in stages[1].select("doc_id").collect()}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    assert {r.doc_id for r in labels if r.quality == 1 and r.toxic == 0} <= kept
    accepted = classified(stages[0], good_labels(spark.read.parquet(f"{FOLDER}/labels.parquet"))).filter("accepted")
    assert kept == {r.doc_id for r in accepted.select("doc_id").collect()}
    assert set(texts(stages[1])) <= set(texts(stages[0]))


def test_lines(stages):
    before = dict(texts(stages[1]))
    wanted = [(d, t) for d, t in lines(texts(stages[1])) if re.search(r"\S", t) or t == before[d]]
    assert texts(stages[2]) == sorted(wanted)
    assert all(r.n_chars == len(r.text) for r in stages[2].collect())


def test_near_duplicates(stages):
    data = texts(stages[2])
    keep = {d for d, _, c in components(data) if d == c}
    assert texts(stages[3]) == [r for r in data if r[0] in keep]


def test_decontamination(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    data = texts(stages[3])
    found = held_items(data, items)
    assert texts(stages[4]) == [r for r in data if not found[r[0]][0]]


def test_bpe(stages):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    wanted = Counter()
    for d, text in texts(stages[4]):
        ids = library.encode(text, add_special_tokens=False).ids
        wanted[d, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))] += 1
    assert Counter(map(tuple, stages[5].collect())) == wanted


def test_near_duplicates_are_rows(spark):
    """Repeated ids stand for other texts, too, and rows without id are rows of their own."""
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    data = [(3, a), (7, a), (7, b), (9, b + " z"), (2, a), (None, b), (None, "c d e f g h"), (None, "c d e f g h"), (5, None), (5, ""), (5, None)]
    docs = spark.createDataFrame([(*d, 1) for d in data], "doc_id bigint, text string, component_id int")
    kept = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.select("doc_id", "text").collect()), key=repr) == sorted([(2, a), (7, b), (None, "c d e f g h"), (5, None), (5, ""), (5, None)], key=repr)
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), FOLDER).count() == 0
