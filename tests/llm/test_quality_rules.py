"""Host rules against brute force."""

import re
from collections import Counter, defaultdict

import pytest

from tonescale.llm.quality_rules import COUNTS, host_rules, text_counts


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in (i, i + 1, i + 2)}
    seen, dups = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dups, len(covered)


TEXTS = [
    None, "", " \n\t ", "a", "a b", "a b c", "a b c a b c", "x x x x", "a b c d a b c", "é🙂 | # $", "one\n\none\n \n one\none",
    "a\x0bb\x0cc\rd\u2003e\xa0f", "w v " * 30_000, "the cat sat " * 20 + "end", " ".join(f"word{i}" for i in range(80)),
]


def test_counts(spark):
    docs = spark.createDataFrame([(i, t, None, 1) for i, t in enumerate(TEXTS)], "doc_id bigint, text string, source string, n_words int")
    found = {r.doc_id: tuple(r[c] for c in COUNTS) for r in text_counts(docs).collect()}
    assert found == {i: plain_counts(t) for i, t in enumerate(TEXTS)}


@pytest.fixture
def judged(spark):
    good, bad = " ".join(f"word{i}" for i in range(80)), "a b"
    data = [(i, good, "clean") for i in range(40)] + [(100 + i, bad if i % 10 else good, "junk") for i in range(40)]
    data += [(None, good, None), (7, good, "clean"), (7, good, "clean")]
    return host_rules(spark.createDataFrame(data, "doc_id bigint, text string, source string")), data


def test_hosts(judged):
    frame, data = judged
    rows = frame.collect()
    assert len(rows) == len(data)
    by_host = defaultdict(set)
    for r in rows:
        by_host[r.host].add(r.kept)
        assert not (r.base_failed and r.kept)
    assert by_host == {"clean": {True}, "junk": {False}, "": {True}}


def test_empty_table(spark):
    assert host_rules(spark.createDataFrame([], "doc_id bigint, text string, source string")).count() == 0


def test_no_python(judged):
    plan = judged[0]._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
