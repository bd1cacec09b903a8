"""BPE encoding and decoding by one table of distinct words.

A word is a run of white space with the characters behind it.  Words end where
white space follows, and there the tokenizer's pattern always ends a pre-token,
so a text's ids are its words' ids in order.  (Splitting only at white space
keeps the table small; pre-tokens inside a word are the encoder's matter.)

1. Texts are packed and dealt once over groups of bounded size.
2. Each group gives its distinct words, sorted and packed by hash bucket; a bucket
   has each word of the whole corpus once, with the groups that hold it.
3. Each word is encoded once, and its ids are joined with the id-to-piece table,
   whose size is the vocabulary's.
4. The words go back to their groups, and each text takes the ids and pieces
   of its words by position.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonescale.llm.batches import pairs, texts_of
from tonescale.llm.token_counts import WHITE, byte_letters

GROUP_BYTES = 32 << 20
MOST_WORDS, WORDS_AT_ONCE = 1_000_000, 10_000
WORD = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")

ENCODED = "doc_id bigint, text_id bigint, n_tokens bigint, ids string, decoded string"
DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


@lru_cache(maxsize=2)
def encoder(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def pieces(path: str) -> dict[int, bytes]:
    """The id-to-piece table of a byte-level vocabulary."""
    spec = json.loads(Path(path).read_text(encoding="utf-8"))
    letters = byte_letters()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    table = {i: bytes(letters[c] for c in t) for t, i in spec["model"]["vocab"].items() if t not in special}
    return table | {i: t.encode() for t, i in special.items()}


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [zlib.compress(text.as_py().encode(), 6) for text in batch.column("text")]
        columns = [batch.column(n) for n in ("part", "text_id", "doc_id")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.binary())], names=["part", "text_id", "doc_id", "packed"])


def _squeeze(value) -> bytes:
    return zlib.compress(json.dumps(value, ensure_ascii=False).encode(), 6)


def _words(buckets: int):
    """Distinct words of each group, sorted and packed by hash bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, set[str]] = defaultdict(set)

        def rows() -> Iterator[pa.RecordBatch]:
            for part, words in found.items():
                by_bucket: dict[int, list[str]] = defaultdict(list)
                for word in sorted(words):
                    by_bucket[zlib.crc32(word.encode()) % buckets].append(word)
                packed = pa.array([_squeeze(w) for w in by_bucket.values()], pa.binary())
                parts = pa.array([part] * len(by_bucket), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(by_bucket, pa.int32()), parts, packed], names=["bucket", "part", "packed"])
            found.clear()

        for batch in batches:
            for part, _, _, packed in pairs(batch):
                found[part].update(set(WORD.findall(zlib.decompress(packed).decode())))
            if sum(map(len, found.values())) > MOST_WORDS:
                yield from rows()
        yield from rows()

    return run


def _joined(words: pa.Table) -> tuple[dict[str, str], dict[str, str]]:
    ids, odd = {}, {}
    for value in words.column("packed"):
        for word, own, decoded in zip(*json.loads(zlib.decompress(value.as_py()))):
            ids[word] = own
            if decoded is not None:
                odd[word] = decoded
    return ids, odd


def _texts(texts: pa.Table, words: pa.Table) -> Iterator[tuple]:
    """Each text's ids and decoded text, by the positions of its words."""
    ids, odd = _joined(words)
    for text_id, doc_id, packed in pairs(texts.select(["text_id", "doc_id", "packed"])):
        own = WORD.findall(zlib.decompress(packed).decode())
        joined = ",".join([ids[w] for w in own])
        decoded = "".join([odd.get(w, w) for w in own] if odd else own)
        yield text_id, doc_id, joined.count(",") + 1 if joined else 0, joined, decoded


def _encoded(texts: pa.Table, words: pa.Table) -> pa.Table:
    rows = [(d, t, n, ids, decoded) for t, d, n, ids, decoded in _texts(texts, words)]
    return _table(rows, ("doc_id", "text_id", "n_tokens", "ids", "decoded"), 3)


def _digests(texts: pa.Table, words: pa.Table) -> pa.Table:
    sha = lambda data: hashlib.sha256(data).hexdigest()
    rows = [
        (d, n, sha(ids.encode()), sha(decoded.encode()))
        for _, d, n, ids, decoded in _texts(texts, words)
    ]
    return _table(rows, ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"), 2)


def _table(rows: list[tuple], names: tuple[str, ...], numbers: int) -> pa.Table:
    columns = zip(*rows) if rows else [[] for _ in names]
    types = [pa.int64()] * numbers + [pa.string()] * (len(names) - numbers)
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=list(names))


def word_table(packed: DataFrame, tokenizer: str, buckets: int) -> DataFrame:
    """part, packed: the words of each group with ids and decoded words, each distinct word encoded once.

    Ids are decimal, joined by commas.  The id-to-piece table has the size of
    the vocabulary and is broadcast, so each id meets its piece where the word
    was encoded.  A decoded word is missing where it equals the word.
    """
    shared = packed.sparkSession.sparkContext.broadcast(pieces(tokenizer))

    def encode(table: pa.Table) -> pa.Table:
        holders: dict[str, list[int]] = defaultdict(list)
        for part, words in pairs(table.select(["part", "packed"])):
            for word in json.loads(zlib.decompress(words)):
                if not (own := holders[word]) or own[-1] != part:
                    own.append(part)
        by_part: dict[int, list[tuple]] = defaultdict(list)
        piece, distinct = shared.value.__getitem__, sorted(holders)
        for start in range(0, len(distinct), WORDS_AT_ONCE):
            words = distinct[start : start + WORDS_AT_ONCE]
            for word, found in zip(words, encoder(tokenizer).encode_batch_fast(words, add_special_tokens=False)):
                decoded = b"".join(map(piece, found.ids)).decode("utf-8", "replace")
                entry = word, ",".join(map(str, found.ids)), None if decoded == word else decoded
                for part in holders[word]:
                    by_part[part].append(entry)
        bundles = pa.array([_squeeze(list(zip(*entries))) for entries in by_part.values()], pa.binary())
        return pa.table([pa.array(by_part, pa.int32()), bundles], names=["part", "packed"])

    words = packed.mapInArrow(_words(buckets), "bucket int, part int, packed binary")
    return words.groupBy("bucket").applyInArrow(encode, "part int, packed binary")


def encode_decode(docs: DataFrame, tokenizer: str, digests: bool = False, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Ids and decoded text of every whole text, or their SHA-256 digests.

    Rows: doc_id, text_id (a row number), n_tokens, ids (decimal, joined by
    commas), decoded; with ``digests`` doc_id, n_tokens, ids_sha256 and
    decoded_sha256.  One row for each input row, repeated and missing ids
    included; a missing or empty text has no ids and decodes to the empty text.
    Special strings in a text become their ids, as in the library.  Other
    columns are ignored.  ``docs`` must be a table or another input that Spark
    computes again in the same order.
    """
    spark = docs.sparkSession
    rows = texts_of(docs)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(math.ceil(size / group_bytes), spark.sparkContext.defaultParallelism)
    row = F.monotonically_increasing_id()
    dealt = rows.select(row.alias("text_id"), "doc_id", "text").withColumn("part", F.pmod("text_id", F.lit(groups)).cast("int"))
    packed = dealt.mapInArrow(_pack, "part int, text_id bigint, doc_id bigint, packed binary").repartition(groups, "part")
    bundles = word_table(packed, tokenizer, groups).repartition(groups, "part")
    both = packed.groupBy("part").cogroup(bundles.groupBy("part"))
    return both.applyInArrow(_digests, DIGESTS) if digests else both.applyInArrow(_encoded, ENCODED)
