"""Encoding and decoding against the tokenizer library."""

import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from test_token_counts import TRAPS
from tonescale.llm.bpe import encode_decode

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_round_trip(spark, library):
    data = [(i, t, "x") for i, t in enumerate(TRAPS)] + [(None, "the end", "y"), (3, None, None), (3, "a b", "z"), (3, "a b", "z")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, ids string")
    found = sorted((r.doc_id, r.n_tokens, r.ids, r.decoded) for r in encode_decode(docs, PATH, group_bytes=1000).collect() if r.doc_id is not None)
    wanted = []
    for i, t, _ in data:
        ids = library.encode(t or "", add_special_tokens=False).ids
        wanted.append((i, len(ids), ",".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)))
    assert found == sorted(w for w in wanted if w[0] is not None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    digests = sorted(map(repr, map(tuple, encode_decode(docs, PATH, digests=True).collect())))
    assert digests == sorted(repr((i, n, sha(a), sha(b))) for i, n, a, b in wanted)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert encode_decode(docs, PATH).count() == 0
