"""The audit of filters against a direct count, over files that come in any order of ids."""

from __future__ import annotations

import itertools
import random
import re

import pytest

from tonescale.llm.filter_audit import FILTERS, filter_audit, packed, unpacked

WORDS = re.compile("[^\x20\x09-\x0d]+")
DOCS = "doc_id bigint, text string, lang string, n bigint, good string"


def failed(text: str) -> str:
    words = WORDS.findall(text)
    tests = {
        "A": len(words) < 100,
        "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
    }
    return "".join(name for name, fails in tests.items() if fails)


def brute(docs: list[tuple], labels: list[tuple]) -> dict[tuple, tuple]:
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, bad in labels if bad == 1 and i is not None}
    rows = []
    for doc_id, text, lang, *_ in docs:
        text = text or ""
        copy = doc_id is not None and any(d[0] is not None and d[0] < doc_id and (d[1] or "") == text for d in docs)
        rows.append((lang or "", failed(text) + "E" * copy, doc_id in good, doc_id in toxic))
    found = {}
    for part in {r[0] for r in rows}:
        own = [r[1:] for r in rows if r[0] == part]
        total = dict.fromkeys(FILTERS, 0)
        for order in itertools.permutations(FILTERS):
            for step, name in enumerate(order, 1):
                earlier = order[: step - 1]
                clean = [r for r in own if not set(earlier) & set(r[0])]
                gone = [r for r in clean if name in r[0]]
                fails = sum(name in r[0] for r in own)
                total[name] += len(gone)
                found[part, "".join(order), step] = [
                    len(clean) - len(gone), len(gone), fails - len(gone), sum(r[0] == name for r in own),
                    sum(r[1] for r in gone), sum(r[2] for r in gone),
                ]
        for (at, order, step), numbers in found.items():
            if at == part:
                numbers.append(total[order[step - 1]])
    return {key: tuple(numbers) for key, numbers in found.items()}


def audit(spark, tmp_path, files: list[list[tuple]], labels: list[tuple], batches: int) -> dict[tuple, tuple]:
    path = str(tmp_path / "documents.parquet")
    for rows in files:
        spark.createDataFrame(rows, DOCS).coalesce(1).write.mode("append").parquet(path)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    rows = filter_audit(spark, path, marks, batches).collect()
    assert len({(r.part, r.filter_order, r.step) for r in rows}) == len(rows)
    return {(r.part, r.filter_order, r.step): tuple(r[name] for name in names) for r in rows}


def corpus(seed: int, rows: int) -> list[tuple]:
    draw = random.Random(seed)
    plain = " ".join(f"w{i}" for i in range(120))
    texts = [
        None, "", " \t\r\n", plain, plain.upper(), plain + " 5 %", "a b " * 60, "A|B", "é" * 30 + "ABC",
        "x y " + plain, "x" * 50_000, "w " * 20_000, "#" + plain,
    ]
    ids = [*range(40), 7, 7, 9, None, None, 2**53 + 1, 2**53]
    return [(draw.choice(ids), draw.choice(texts), draw.choice(["en", "de", None, ""]), 1, "clash") for _ in range(rows)]


@pytest.mark.parametrize("files, batches", [(1, 4), (5, 5), (6, 2)])
def test_equals_brute_force(spark, tmp_path, files, batches):
    docs = sorted(corpus(files, 90), key=lambda d: -(d[0] or 0))  # smaller ids come later
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(30)] + [(None, 1, 1), (7, 1, None), (7, None, 1), (8, None, None)]
    size = -(-len(docs) // files)
    parts = [docs[i : i + size] for i in range(0, len(docs), size)]
    assert audit(spark, tmp_path, parts, labels, batches) == brute(docs, labels)


def test_no_rows_and_no_labels(spark, tmp_path):
    assert audit(spark, tmp_path, [[]], [], 3) == {}


def test_no_labels(spark, tmp_path):
    docs = [(3, "same", "en", 0, ""), (3, "same", "en", 0, ""), (1, "same", None, 0, ""), (None, "same", "en", 0, "")]
    assert audit(spark, tmp_path, [docs[:2], docs[2:]], [], 2) == brute(docs, [])


def test_state_keeps_its_texts():
    held = {b"k": (5, {"en": [2, 1, 0], "": [1, 0, 0]}), b"\x00": (-(2**40), {"de": [1, 1, 1]})}
    assert unpacked(packed(held)) == held
