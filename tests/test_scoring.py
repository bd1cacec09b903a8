import random
import re

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tonescale.operators import documents as docs_ops
from tonescale.operators import scoring

FORMS = ("literal", "bucketed", "broadcast", "shuffled")
EXPECTED = [
    (1, 2, 2, 0, "positive"),
    (3, 2, 2, 0, "positive"),
    (6, 0, 0, 0, "neutral"),
    (8, 1, 1, 0, "positive"),
    (9, 0, 0, 0, "neutral"),
    (10, 1, 1, 0, "positive"),
    (11, -1, 1, 2, "negative"),
    (12, 0, 1, 1, "neutral"),
    (14, 0, 0, 0, "neutral"),
]
COLUMNS = ("doc_id", "score", "positive_hits", "negative_hits", "predicted_sentiment")


@pytest.mark.parametrize("form", FORMS)
def test_edge_rows(edge_documents, edge_lexicon, form):
    prepared = docs_ops.prepare_documents(edge_documents)
    scored = prepared.transform(scoring.score_documents(edge_lexicon, form))
    assert rows(scored, *COLUMNS) == sorted(EXPECTED, key=repr)
    assert set(prepared.columns) < set(scored.columns)


@pytest.mark.parametrize("form", FORMS)
def test_corpus_in_one_pass(edge_documents, edge_lexicon, form):
    scored = scoring.score_corpus(edge_documents, edge_lexicon, form, carry=["label"])
    assert rows(scored, *COLUMNS) == sorted(EXPECTED, key=repr)
    labels = {r.doc_id: r.label for r in scored.collect()}
    assert labels[1] == "positive" and labels[9] is None
    assert scored.agg(F.sum("token_count")).first()[0] == 27


def random_corpus(spark, seed, partitions):
    """Documents of which one word makes up a third of the tokens."""
    generator = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(300):
        picked = [generator.choice(words) for _ in range(generator.randrange(0, 40))]
        texts.append((i, picked + ["hot"] * (len(picked) // 2)))
    frame = spark.createDataFrame(texts, "doc_id bigint, tokens array<string>")
    weights = {f"W{i}": generator.randrange(-3, 4) for i in range(0, 60, 2)} | {"hot": -2}
    return frame.repartition(partitions), texts, weights


def brute_force(texts, weights):
    folded = {word.lower(): weight for word, weight in weights.items()}
    result = []
    for doc_id, tokens in texts:
        values = [folded.get(token.lower(), 0) for token in tokens]
        score = sum(values)
        result.append(
            (
                doc_id,
                score,
                sum(v > 0 for v in values),
                sum(v < 0 for v in values),
                "positive" if score > 0 else "negative" if score < 0 else "neutral",
            )
        )
    return sorted(result, key=repr)


@pytest.mark.parametrize("partitions", [1, 7])
@pytest.mark.parametrize("form", FORMS)
def test_forms_equal_brute_force(spark, form, partitions):
    docs, texts, weights = random_corpus(spark, 11, partitions)
    lexicon = scoring.lexicon_table(spark, weights)
    scored = docs.transform(scoring.score_documents(lexicon, form))
    assert rows(scored, *COLUMNS) == brute_force(texts, weights)


@pytest.mark.parametrize("hot_parts", [2, 5, 10**6])
def test_shuffled_form_with_and_without_hot_tokens(spark, hot_parts):
    docs, texts, weights = random_corpus(spark, 12, 3)
    lexicon = scoring.lexicon_table(spark, weights)
    scores = scoring.shuffled_scores(docs, lexicon, hot_parts=hot_parts)
    assert rows(scores, *COLUMNS[:4]) == sorted((r[:4] for r in brute_force(texts, weights)), key=repr)


def test_missing_fields_and_case(spark, edge_lexicon):
    docs = spark.createDataFrame(
        [(None, ["PROFIT"]), (None, ["Loss"]), (3, None), (4, ["profit", None])],
        "doc_id bigint, tokens array<string>",
    )
    scored = docs.transform(scoring.score_documents(edge_lexicon))
    assert rows(scored, "doc_id", "score") == [(-1, -1), (-1, 1), (3, 0), (4, 1)]


def test_zero_weights_and_empty_lexicon(spark):
    docs = spark.createDataFrame([(1, ["a", "b"])], "doc_id bigint, tokens array<string>")
    for weights in ({"a": 0}, {}):
        for form in FORMS:
            lexicon = scoring.lexicon_table(spark, weights)
            scored = docs.transform(scoring.score_documents(lexicon, form))
            assert rows(scored, *COLUMNS) == [(1, 0, 0, 0, "neutral")]


@pytest.mark.parametrize("terms", [1, 128, 129, 20_000])
def test_repeated_and_missing_ids_at_every_lexicon_size(spark, terms):
    data = [(1, ["profit"]), (1, ["loss", "Profit", "profit"]), (None, ["profit"]), (None, ["x"]), (None, None), (2, ["loss", None])]
    docs = spark.createDataFrame(data, "doc_id bigint, tokens array<string>")
    weights = {"profit": 1, **{f"t{i}": -1 for i in range(terms - 1)}}
    lexicon = scoring.lexicon_table(spark, weights)
    expected = sorted(((-1 if i is None else i), sum((t or "").lower() == "profit" for t in tokens or [])) for i, tokens in data)
    for form in ("auto", "bucketed", "broadcast", "shuffled"):
        assert rows(docs.transform(scoring.score_documents(lexicon, form)), "doc_id", "score") == expected


@pytest.mark.parametrize("terms", [1, 128, 129, 20_000])
def test_corpus_of_repeated_and_missing_ids_at_every_lexicon_size(spark, terms):
    data = [
        (1, "profit", "b"), (1, "profit", "a"), (1, "loss Profit profit", "c"), (None, "profit", "0"), (None, "x", "e"),
        (None, "x", "d"), (None, "Loss t0", None), (2, "loss", "f"), (3, "loss", "g"), (None, " .", "h"), (4, "profit  x", "i"),
    ]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, tag string").repartition(3)
    weights = {"profit": 1, **{f"t{i}": -1 for i in range(terms - 1)}}
    lexicon = scoring.lexicon_table(spark, weights)
    t0 = -1 if terms > 1 else 0
    expected = [(1, 1, 1, "a"), (1, 2, 3, "c"), (-1, 0, 1, "d"), (-1, t0, 2, None), (2, 0, 1, "f"), (4, 1, 2, "i")]
    for form in ("auto", "bucketed", "broadcast", "shuffled"):
        scored = scoring.score_corpus(docs, lexicon, form, carry=["tag"])
        assert rows(scored, "doc_id", "score", "token_count", "tag") == sorted(expected, key=repr)


def test_lexicon_hits_count_documents_without_ids(spark):
    data = [(None, ["up", "up"]), (None, ["up"]), (1, ["up", "x"]), (1, ["up"])]
    docs = spark.createDataFrame(data, "doc_id bigint, tokens array<string>")
    assert rows(scoring.lexicon_hits(docs, scoring.lexicon_table(spark, {"up": 1}))) == [("up", 1, 5, 4)]


@pytest.mark.parametrize("form", FORMS)
def test_lexicon_tables_are_folded_and_unique(spark, form):
    docs = spark.createDataFrame([(1, ["that", "THAT"])], "doc_id bigint, tokens array<string>")

    def score(*terms):
        lexicon = spark.createDataFrame(terms, "token string, weight bigint")
        return rows(docs.transform(scoring.score_documents(lexicon, form)), "score")

    assert score(("That", 2), ("that", 2)) == [(4,)]
    for wrong in ([("that", 1), ("That", 3)], [("that", None)], [(None, 1)]):
        with pytest.raises(PySparkException, match="without one weight"):
            score(*wrong)


def test_form_follows_the_size_of_the_lexicon(spark, monkeypatch):
    def form_of(terms):
        return scoring.choose_form(scoring.lexicon_table(spark, {f"t{i}": 1 for i in range(terms)}))[0]

    assert form_of(scoring.LITERAL_TERMS) == "literal"
    assert form_of(scoring.LITERAL_TERMS + 1) == "bucketed"
    monkeypatch.setattr(scoring, "BROADCAST_BYTES", 1000)
    assert form_of(scoring.LITERAL_TERMS + 1) == "shuffled"
    large = scoring.lexicon_table(spark, {f"t{i}": 1 for i in range(scoring.LITERAL_TERMS + 1)})
    assert scoring.choose_form(large, "literal")[0] == "literal"
    monkeypatch.setattr(scoring, "LITERAL_TERMS_ON_REQUEST", scoring.LITERAL_TERMS)
    with pytest.raises(ValueError):
        scoring.choose_form(large, "literal")
    for form in ("bucketed", "broadcast", "fast"):
        with pytest.raises(ValueError):
            scoring.choose_form(large, form)


@pytest.mark.parametrize("limit", [10**9, 0])
def test_lexicon_hits(edge_documents, edge_lexicon, monkeypatch, limit):
    monkeypatch.setattr(scoring, "BROADCAST_BYTES", limit)
    hits = scoring.lexicon_hits(docs_ops.prepare_documents(edge_documents), edge_lexicon)
    assert rows(hits) == [
        ("growth", 1, 1, 1),
        ("loss", -1, 3, 2),
        ("profit", 1, 4, 4),
        ("rose", 1, 2, 2),
        ("up", 1, 1, 1),
    ]


def test_bucketed_form_with_200_000_terms(spark):
    terms = spark.range(200_000).selectExpr("concat('T', id) AS token", "id % 7 - 3 AS weight")
    docs = spark.range(300).selectExpr("id AS doc_id", "transform(sequence(0, 40), i -> concat('t', (id * 977 + i * 5003) % 230000)) AS tokens")
    found = [rows(docs.transform(scoring.score_documents(terms, form)), *COLUMNS) for form in ("bucketed", "broadcast")]
    assert found[0] == found[1] and any(r[1] for r in found[0])


def test_bucketed_form_keeps_the_lexicon_out_of_the_rows(spark):
    """The buckets are used inside the lambda, as a subquery, in a plan without join or shuffle of documents."""
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string").selectExpr("doc_id", "split(text, ' ') AS tokens")
    lexicon = scoring.lexicon_table(spark, {f"t{i}": 1 for i in range(200)})
    plan = docs.transform(scoring.score_documents(lexicon))._jdf.queryExecution().executedPlan().toString()
    documents = re.sub(r"(?m)^[ :|]*[:|].*$", "", plan)  # without the lines of the subquery's own plan
    assert "_buckets" not in plan and "Subquery" in plan
    assert "Exchange" not in documents and "Join" not in documents


def test_a_transform_checks_its_lexicon_once(spark, monkeypatch):
    calls = []
    check = scoring.checked_lexicon
    monkeypatch.setattr(scoring, "checked_lexicon", lambda *a: calls.append(1) or check(*a))
    docs = spark.createDataFrame([(1, ["that"])], "doc_id bigint, tokens array<string>")
    score = scoring.score_documents(scoring.lexicon_table(spark, {"that": 1}))
    assert [rows(docs.transform(score), "score") for _ in range(2)] == [[(1,)]] * 2 and len(calls) == 1


def test_shuffled_form_moves_tokens_by_block(spark, monkeypatch):
    """The table that meets the lexicon has the distinct tokens of blocks, not those of every document."""
    written = {}
    write = scoring.write_once
    monkeypatch.setattr(scoring, "write_once", lambda frame, name: written.setdefault(name, write(frame, name)))
    docs = spark.range(0, 200, 1, 2).selectExpr("id AS doc_id", "transform(sequence(0, 29), i -> concat('t', i)) AS tokens")
    scores = scoring.shuffled_scores(docs, scoring.lexicon_table(spark, {"t1": 2, "t2": -1}))
    assert rows(scores, *COLUMNS[:4], "token_count") == sorted(((i, 1, 1, 1, 30) for i in range(200)), key=repr)
    assert max(frame.count() for name, frame in written.items() if "token" in name) == 60


@pytest.mark.parametrize("size", [1, 100, 10**6])
def test_shuffled_form_with_blocks_of_any_size(spark, monkeypatch, size):
    monkeypatch.setattr(scoring, "BLOCK_BYTES", size)
    monkeypatch.setattr(scoring, "SMALL", 16)
    monkeypatch.setattr(scoring, "BLOCK_BUCKETS", 3)
    docs, texts, weights = random_corpus(spark, 13, 3)
    odd = [(1000, ["a\nb", "w2"]), (1001, [""]), (1002, ["", ""]), (1003, []), (1004, ["hot\n"]), (1005, ["\n", "hot"]), (1006, ["x" * 500, "hot"])]
    weights |= {"a\nb": 5, "": 7, "hot\n": 11, "\n": 13}
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    scores = scoring.shuffled_scores(docs, scoring.as_lexicon(scoring.lexicon_table(spark, weights)))
    assert rows(scores, *COLUMNS[:4]) == sorted((r[:4] for r in brute_force(texts + odd, weights)), key=repr)
    assert rows(scores, "doc_id", "token_count") == sorted(((i, len(t)) for i, t in texts + odd), key=repr)


def test_shuffled_scores_refuse_repeated_ids(spark):
    docs = spark.createDataFrame([(1, ["a"]), (1, ["b"])], "doc_id bigint, tokens array<string>")
    with pytest.raises(PySparkException, match="not unique"):
        scoring.shuffled_scores(docs, scoring.lexicon_table(spark, {"a": 1})).collect()


def test_bucketed_form_beyond_the_bound_of_one_row(spark, monkeypatch):
    """Such a lexicon comes by blocks of documents; a stream still refuses it."""
    docs, texts, weights = random_corpus(spark, 14, 3)
    lexicon = scoring.lexicon_table(spark, weights)
    monkeypatch.setattr(scoring, "BROADCAST_BYTES", 1000)
    assert rows(docs.transform(scoring.score_documents(lexicon, "bucketed")), *COLUMNS) == brute_force(texts, weights)
    raw = docs.filter("size(tokens) > 0").selectExpr("doc_id", "concat_ws(' ', doc_id + 1000, array_join(tokens, ' ')) AS text")
    wanted = [r for r, (_, tokens) in zip(sorted(brute_force(texts, weights)), texts) if tokens]
    assert rows(scoring.score_corpus(raw, lexicon, "bucketed"), *COLUMNS) == sorted(wanted, key=repr)
    stream = spark.readStream.format("rate").load().selectExpr("value AS doc_id", "array('w0') AS tokens")
    with pytest.raises(ValueError, match="a stream takes"):
        scoring.score_documents(lexicon, "bucketed")(stream)
