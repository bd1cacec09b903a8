import json
import random

import pytest
from conftest import rows

from tonescale.operators import numbering
from tonescale.sources import documents as source
from tonescale.sources import lexicon as lexicons
from tonescale.sources.records import load_predictions, load_token_records


def write(path, content, encoding="utf-8"):
    path.write_bytes(content.encode(encoding))
    return str(path)


CSV = 'positive,"Said ""yes"", twice"\nneutral,"two\nlines, é"\nnegative,NA\n,plain\npositive,\n'


def test_csv(spark, tmp_path):
    path = write(tmp_path / "all.csv", CSV, "latin-1")
    assert rows(source.load_documents(spark, path), "label", "text") == sorted(
        [
            ("positive", 'Said "yes", twice'),
            ("neutral", "two\nlines, é"),
            ("negative", "NA"),
            (None, "plain"),
            ("positive", None),
        ],
        key=repr,
    )


def test_csv_with_na_literals(spark, tmp_path):
    path = write(tmp_path / "all.csv", CSV, "latin-1")
    texts = [r.text for r in source.load_documents(spark, path, pandas_na=True).collect()]
    assert texts.count(None) == 2 and "NA" not in texts


def test_csv_without_line_breaks_is_splittable(spark, tmp_path):
    path = write(tmp_path / "all.CSV", 'positive,"a ""b"""\nneutral,c\n', "latin-1")
    docs = source.load_documents(spark, path, multi_line=False)
    assert rows(docs, "label", "text") == [("neutral", "c"), ("positive", 'a "b"')]


def test_json_records(spark, tmp_path):
    path = write(tmp_path / "a.json", json.dumps([{"text": "x", "label": None}, {"text": "y"}, {"label": "z"}]))
    assert rows(source.load_documents(spark, path), "text", "label") == sorted(
        [("x", None), ("y", None), (None, "z")], key=repr
    )


def test_json_columns(spark, tmp_path):
    path = write(tmp_path / "a.json", json.dumps({"text": ["x", "y"], "label": ["p", "n"]}))
    assert rows(source.load_documents(spark, path), "text", "label") == [("x", "p"), ("y", "n")]


def test_json_keyed_by_index_is_refused(spark, tmp_path):
    path = write(tmp_path / "a.json", json.dumps({"text": {"0": "x", "1": "y"}}))
    with pytest.raises(ValueError, match="row index"):
        source.load_documents(spark, path)


def test_jsonl(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", '{"text": "x"}\n\n  \n{"text": "y", "label": "p"}\n')
    assert rows(source.load_documents(spark, path), "text", "label") == [("x", None), ("y", "p")]
    bad = write(tmp_path / "b.jsonl", '{"text": "x"}\n{"text": \n')
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        source.load_documents(spark, bad, schema="text string").collect()


def test_lines(spark, tmp_path):
    path = write(tmp_path / "a.txt", "  x y \n\n\t\n z \r\nlast")
    assert rows(source.load_documents(spark, path)) == [("last",), ("x y",), ("z",)]


def test_parquet_and_column_names(spark, tmp_path):
    path = str(tmp_path / "p.parquet")
    spark.createDataFrame([(1, "a", "b")], "id int, Body string, Review string").write.parquet(path)
    assert source.load_documents(spark, path).first().text == "b"
    assert source.load_documents(spark, path, text_column="Body").first().text == "a"
    with pytest.raises(ValueError, match="not found"):
        source.load_documents(spark, path, text_column="missing")


def test_text_column_falls_back_to_the_first_string(spark):
    frame = spark.createDataFrame([(1, "a", "b")], "id int, first string, second string")
    assert source.resolve_text_column(frame) == "first"
    with pytest.raises(ValueError):
        source.resolve_text_column(frame.select("id"))


def test_unknown_format_and_missing_file(spark, tmp_path):
    with pytest.raises(ValueError, match="unsupported"):
        source.load_documents(spark, str(tmp_path / "a.xml"))
    with pytest.raises(ValueError, match="unsupported"):
        source.load_documents(spark, str(tmp_path / "plain"))
    for suffix in ("csv", "json", "jsonl", "txt", "parquet"):
        with pytest.raises(FileNotFoundError):
            source.load_documents(spark, str(tmp_path / f"none.{suffix}"))


def lexicon(spark, tmp_path, content):
    path = write(tmp_path / "lexicon.json", content if isinstance(content, str) else json.dumps(content))
    return rows(lexicons.load_lexicon(spark, path), "token", "weight")


def test_lexicon_flat_and_nested(spark, tmp_path):
    expected = [("bad", -1), ("good", 1)]
    assert lexicon(spark, tmp_path, {"Good": 1, "bad": -1}) == expected
    assert lexicon(spark, tmp_path, {"p": {"Good": 1}, "n": {"BAD": -1}}) == expected
    assert lexicon(spark, tmp_path, {}) == []


def test_lexicon_last_of_equal_words_counts(spark, tmp_path):
    assert lexicon(spark, tmp_path, {"Good": 1, "good": -3}) == [("good", -3)]
    assert lexicon(spark, tmp_path, '{"good": 5, "x": 1, "good": 2}') == [("good", 2), ("x", 1)]
    assert lexicon(spark, tmp_path, '{"a": {"good": 5, "good": 4}, "b": {"GOOD": 7}}') == [("good", 7)]


@pytest.mark.parametrize("weight", ["1.5", '"2"', "true", "null", "[1]"])
def test_lexicon_weights_must_be_integers(spark, tmp_path, weight):
    for content in (f'{{"word": {weight}}}', f'{{"block": {{"word": {weight}}}}}'):
        with pytest.raises(ValueError, match="integer"):
            lexicon(spark, tmp_path, content)


def test_lexicon_shape_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="block 'word'"):
        lexicon(spark, tmp_path, {"block": {"a": 1}, "word": 1})
    with pytest.raises(ValueError, match="object"):
        lexicon(spark, tmp_path, "[1, 2]")
    with pytest.raises(FileNotFoundError):
        lexicons.load_lexicon(spark, str(tmp_path / "none.json"))


def test_records_must_be_lists(spark, tmp_path):
    path = write(tmp_path / "tokens.json", '\n [{"doc_id": 1, "tokens": ["a"], "label": "x"}, {"doc_id": 2}]')
    assert rows(load_token_records(spark, path), "doc_id", "tokens", "label") == [
        (1, ["a"], "x"),
        (2, None, None),
    ]
    single = write(tmp_path / "single.json", '{"doc_id": 1}')
    for load in (load_token_records, load_predictions):
        with pytest.raises(ValueError, match="list"):
            load(spark, single)
        with pytest.raises(FileNotFoundError):
            load(spark, str(tmp_path / "none.json"))
        with pytest.raises(ValueError, match="format"):
            load(spark, single, "xml")


@pytest.mark.parametrize("text", ['{"good": 1', '{"good": 1, "bad": ', "", '{"good": 1} trailing', '{"a": 1} {"b": 2}', "[1]", "7"])
def test_lexicon_must_be_one_whole_object(spark, tmp_path, text):
    (tmp_path / "lexicon.json").write_text(text)
    with pytest.raises(ValueError):
        lexicons.load_lexicon(spark, str(tmp_path / "lexicon.json"))


def test_empty_lexicon_object(spark, tmp_path):
    (tmp_path / "lexicon.json").write_text(" {} ")
    assert lexicons.load_lexicon(spark, str(tmp_path / "lexicon.json")).count() == 0


def test_csv_with_an_unquoted_comma_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("q,Profit rose, strongly\n")
    with pytest.raises(Exception):
        source.read_csv(spark, str(tmp_path / "a.csv")).collect()


def test_columns_must_be_equally_long(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"text": ["a", "b", "c"], "label": ["p"]}')
    with pytest.raises(Exception, match="unequal length"):
        source.read_json(spark, str(tmp_path / "a.json")).collect()


def test_scalars_are_repeated(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"text": ["a", "b"], "lang": "en"}')
    assert rows(source.read_json(spark, str(tmp_path / "a.json")), "lang", "text") == [("en", "a"), ("en", "b")]


def test_list_after_much_white_space(spark, tmp_path):
    (tmp_path / "a.json").write_text(" " * 1200 + '[{"doc_id": 1, "tokens": ["a"]}]')
    assert load_token_records(spark, str(tmp_path / "a.json")).count() == 1


def test_csv_documents_keeps_every_character(spark, tmp_path):
    from tonescale.plans.queries import csv_documents

    texts = ["zażółć gęślą jaźń", "Ελληνικά, \"λόγια\"", "漢字\nかな", "café 😀", "plain"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    read = csv_documents(spark, str(tmp_path)).collect()
    assert [r.text for r in sorted(read, key=lambda r: r.doc_id)] == texts


def _records(seed):
    draw = random.Random(seed)
    texts = ["plain", "a,b", 'say "yes"', '"', '""', "two\nlines", "\n\n", "crlf\r\ninside", "x" * 300, "", " spaced ", "é“", "\\", "\r\n"]
    return [(f"l{i}", draw.choice(texts) + draw.choice(["", str(i)])) for i in range(700)]


def _as_csv(records, end):
    return "".join(f'{label},"{text.replace(chr(34), chr(34) * 2)}"{end}' for label, text in records)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [700, 9_000, 10**9])
def test_quoted_line_breaks_in_splits(spark, tmp_path, end, size):
    parts = {f"part-{n}-x.csv": _records(n) for n in (9, 10, 100)}
    for name, records in parts.items():
        write(tmp_path / name, _as_csv(records, end))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        docs = source.load_documents(spark, str(tmp_path), "csv", encoding="UTF-8", located=True)
        splits = docs.select("_path", "_start").distinct().count()
        found = [(r.label, r.text) for r in numbering.assign_doc_ids(docs).orderBy("doc_id").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == [(label, text or None) for records in parts.values() for label, text in records]
    assert splits > 10 or size > 700


def test_quoted_csv_equals_whole_file_reading(spark, tmp_path):
    records = [(label, text.replace("\r", "")) for label, text in _records(1)]
    path = write(tmp_path / "a.csv", _as_csv(records, "\n") + "\n\nlast,no quotes")
    split, whole = (source.read_csv(spark, path, "UTF-8", splits=s) for s in (True, False))
    assert rows(split) == rows(whole) and split.count() == 701


def test_quoted_csv_errors(spark, tmp_path):
    for i, bad in enumerate(['a,b,c\n', '"only one"\n', 'x,"a\nb",c\n']):
        path = write(tmp_path / f"{i}.csv", 'ok,"fine\nhere"\n' + bad)
        with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
            source.load_documents(spark, path).select("text").collect()
    with pytest.raises(ValueError, match="encoding"):
        source.read_csv(spark, str(tmp_path), encoding="UTF-16")
