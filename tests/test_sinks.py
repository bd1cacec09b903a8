import json
from pathlib import Path

import pytest
from conftest import rows

from tonescale.operators import documents as docs_ops
from tonescale.operators import evaluation, numbering, scoring, summaries
from tonescale.operators import vocabulary as words
from tonescale.sinks import writers
from tonescale.sources.records import load_partials, load_predictions, load_token_records


def records(path):
    lines = [line for file in Path(path).glob("part-*") for line in file.read_text().splitlines()]
    return [json.loads(line) for line in lines]


@pytest.fixture(scope="module")
def prepared(edge_documents):
    return docs_ops.prepare_documents(edge_documents)


@pytest.fixture(scope="module")
def scored(prepared, edge_lexicon):
    return prepared.transform(scoring.score_documents(edge_lexicon))


@pytest.mark.parametrize("fmt,read", [("json", "jsonl"), ("parquet", "parquet")])
def test_token_records(spark, prepared, tmp_path, fmt, read):
    path = str(tmp_path / "tokens")
    writers.write_token_records(prepared, path, fmt)
    back = load_token_records(spark, path, read)
    assert rows(back, "doc_id", "original_text", "tokens", "label") == rows(
        prepared, "doc_id", "text", "tokens", "label"
    )


def test_cleaned_csv(spark, prepared, tmp_path):
    path = str(tmp_path / "cleaned")
    writers.write_cleaned_csv(prepared, path)
    back = spark.read.csv(path, header=True, escape='"', multiLine=True)
    assert back.columns == ["doc_id", "text", "cleaned_text", "tokens", "token_count", "label"]
    by_id = {r.doc_id: r for r in back.collect()}
    assert json.loads(by_id["14"].tokens) == ["café", "über", "straße"]
    assert by_id["14"].text == "CAFÉ\tÜBER\nStraße" and by_id["11"].label == " Positive "


def test_vocabulary_in_order(spark, prepared, tmp_path):
    ranked = words.ranked_vocabulary(prepared)
    expected = [
        (r.token, r.frequency) for r in ranked.orderBy(*words.frequency_order()).collect()
    ]
    writers.write_vocabulary(ranked, str(tmp_path / "vocabulary"))
    writers.write_top_words(ranked, str(tmp_path / "top"))
    assert sorted((r["token"], r["frequency"]) for r in records(tmp_path / "vocabulary")) == sorted(expected)
    read = spark.read.schema("token string, frequency bigint").csv(str(tmp_path / "top"), header=True)
    numbered = numbering.assign_doc_ids(read).orderBy("doc_id").collect()
    assert [(r.token, r.frequency) for r in numbered] == expected


def test_corpus_report(prepared, tmp_path):
    writers.write_summary(words.corpus_report(prepared, "in.csv"), str(tmp_path / "summary"))
    (report,) = records(tmp_path / "summary")
    assert report["total_tokens"] == 27 and report["top_20_words"][0] == {"token": "profit", "frequency": 4}


def test_scored_and_mapper_results(spark, scored, tmp_path):
    writers.write_scored(scored, str(tmp_path / "scored"))
    writers.write_mapper_results(scored, str(tmp_path / "mapped"))
    first = {r["doc_id"]: r for r in records(tmp_path / "scored")}[9]
    assert first["label"] is None and first["positive_hits"] == 0
    mapped = {r["doc_id"]: r for r in records(tmp_path / "mapped")}
    assert mapped[11]["true_label"] == "positive"
    assert set(mapped[9]) == {"doc_id", "tokens", "predicted_sentiment", "score"}
    back = load_predictions(spark, str(tmp_path / "mapped"), "jsonl")
    assert rows(back, "doc_id", "score") == rows(scored, "doc_id", "score")


def test_unknown_accuracy_is_null_or_left_out(scored, tmp_path):
    summary = summaries.summarize(scored.drop("label"))
    writers.write_summary(summary, str(tmp_path / "kept"))
    writers.write_summary(summary, str(tmp_path / "left"), keep_nulls=False)
    assert records(tmp_path / "kept")[0]["accuracy"] is None
    assert "accuracy" not in records(tmp_path / "left")[0]


def test_partials_round_trip(spark, scored, tmp_path):
    partials = summaries.partial_summary(numbering.assign_chunks(scored, 4), "chunk_id")
    writers.write_partials(partials, str(tmp_path / "partials"))
    back = load_partials(spark, str(tmp_path / "partials"))
    assert summaries.merge_partials(back).first() == summaries.summarize(scored).first()


def test_validated_and_metrics(scored, tmp_path):
    validated = evaluation.validate_predictions(scored)
    writers.write_scored(validated, str(tmp_path / "validated"))
    writers.write_summary(
        evaluation.metrics_report(evaluation.evaluation_counts(validated)), str(tmp_path / "metrics")
    )
    (report,) = records(tmp_path / "metrics")
    assert report["class_metrics"]["negative"] == {"precision": 0.0, "recall": None, "f1": None, "support": 0}
    assert report["confusion_matrix"]["positive"]["neutral"] == 1
    assert len(records(tmp_path / "validated")) == 9


def test_existing_output_is_not_overwritten(scored, tmp_path):
    path = str(tmp_path / "out")
    writers.write_scored(scored, path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writers.write_scored(scored, path)
    with pytest.raises(ValueError):
        writers.write_scored(scored, str(tmp_path / "x"), "xml")
