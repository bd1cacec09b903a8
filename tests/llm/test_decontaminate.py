"""Containment search against brute force."""

import random

import pytest

from test_jaccard_join import shingles
from tonescale.llm.decontaminate import contaminated


def brute(docs, items):
    found = {}
    for d, text, *_ in docs:
        own = shingles(text)
        found.setdefault(d, []).append(
            [i for i, t in sorted({(i, t) for i, t in items if i is not None and t}) if (s := shingles(t)) and len(s & own) >= 0.8 * len(s)]
        )
    return found


@pytest.mark.parametrize("block", [3, 1000])
def test_against_brute_force(spark, block):
    rng = random.Random(5)
    word = lambda: f"w{rng.randint(0, 800)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([3, 5, 6, 15, 16, 30, 60, 200])))) for i in range(40)]
    items += [(None, "a b c d e f"), (90, None), (91, ""), (92, "just three words")]
    docs = [(None, "plain", "x"), (1, None, "x"), (2, "", "x"), (3, "Just THREE words", "x"), (3, "Just THREE words", "x")]
    for d in range(10, 60):
        words = [word() for _ in range(rng.choice([0, 10, 300, 5000]))]
        for _ in range(rng.randint(0, 3)):
            part = rng.choice(items[:40])[1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                part[rng.randrange(len(part))] = word()
            at = rng.randint(0, len(words))
            words[at:at] = part
        docs.append((d, " ".join(words), "x"))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, hits string")
    table = spark.createDataFrame(items, "item_id bigint, text string")
    found = {}
    for r in contaminated(frame, table, block=block).collect():
        found.setdefault(r.doc_id, []).append([h.item_id for h in r.hits])
    assert found == brute(docs, items)
    assert any(any(v) for v in found.values())


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"), spark.createDataFrame([], "item_id bigint, text string")
    assert [r.hits for r in contaminated(docs, items).collect()] == [[]]
    assert contaminated(docs.limit(0), items).count() == 0
