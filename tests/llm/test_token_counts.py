"""The counting transducer against the tokenizer library."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tonescale.llm.token_counts import Transducer, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
TRAPS = [
    "", " ", "   ", "\n\n", "it's we're I'll 've ' 's 'r 'lx ''s !'s x's's", "a  b \n\n c\t\td  ",
    "x<|endoftext|>  y <|endoftext|><|endoftext|>z <|endoftext|", "\x85\xa0 　a\x1c\x1db",
    "日本語 テスト", "a" * 20_000, "🙂🙂 👩‍👩‍👧 é", "½²Ⅷ٣ 123abc", " ".join(["tion"] * 5000),
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def machine():
    return Transducer(PATH)


@pytest.mark.parametrize("size", [1, 2, 7, 8192])
def test_traps(machine, library, size):
    for text in TRAPS:
        assert machine.scan([machine.chunk_map(c) for c in machine.chunks(text, size)]) == library(text)


def test_random_texts(machine, library):
    random.seed(7)
    letters = "ab 'srelvtmd\n\t!1²é日\xa0 <|>🙂"
    for _ in range(3000):
        text = "".join(random.choices(letters, k=random.randint(1, 60)))
        assert machine.count(text) == machine.scan([machine.chunk_map(c) for c in machine.chunks(text, 5)]) == library(text)


def test_composition_is_associative(machine):
    a, b, c = (machine.chunk_map(x) for x in ("the ti", "on of", " xs  y"))
    left, right = machine.compose(machine.compose(a, b), c), machine.compose(a, machine.compose(b, c))
    assert left[:2] == right[:2]


def test_flush_keeps_results(library, monkeypatch):
    monkeypatch.setattr("tonescale.llm.token_counts.MAX_STATES", 50)
    monkeypatch.setattr("tonescale.llm.token_counts.MAX_WORDS", 3)
    small = Transducer(PATH)
    assert [small.count(t) for t in TRAPS] == [library(t) for t in TRAPS]


def test_rows(spark, library):
    data = [(1, "the end", "x"), (1, "the end", "x"), (None, "a b", None), (3, None, "y"), (4, "", None)]
    data += [(10 + i, t, None) for i, t in enumerate(TRAPS)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, n_tokens string")
    found = sorted(map(tuple, count_tokens(docs, PATH, over=100, chunk=50).collect()), key=repr)
    wanted = [(i, len((t or "").encode()), library(t or ""), library(t or "") > 100) for i, t, _ in data]
    assert found == sorted(wanted, key=repr)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert count_tokens(docs, PATH).columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert count_tokens(docs, PATH).count() == 0


def test_words_met_before_the_flush_stay_known(library, monkeypatch):
    monkeypatch.setattr("tonescale.llm.token_counts.MAX_WORDS", 3)
    small = Transducer(PATH)
    known = [small.word(w) for w in (" one", " two", " six")]
    small.word(" ten")
    monkeypatch.setattr(small, "run", lambda *a: pytest.fail("counted again"))
    assert [small.word(w) for w in (" one", " two")] == known[:2]


def test_last_characters_make_no_states(machine, library):
    machine.word(" zqxjzqx")
    made = len(machine.states)
    words = [" zqxjzqx" + c for c in "abcdeé1! 'sᵃ\t"]
    assert [machine.word(w) for w in words] == [library(w) for w in words]
    assert len(machine.states) <= made + 1  # the place behind the prefix itself
