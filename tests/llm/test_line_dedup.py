"""Line dedup against brute force."""

import random
import re

import pytest

from tonescale.llm.line_dedup import dedup_lines


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def brute(data, least=16):
    places = {}
    for d, text, *_ in data:
        for k, line in enumerate((text or "").split("\n") if text is not None else []):
            if re.search(r"[^\x20\x09-\x0D]", line):
                at = (float("inf") if d is None else d, k)
                places[line] = min(places.get(line, at), at)
    lines = sorted(places)
    near = {
        x for x in lines if len(x) >= least and any(len(y) >= least and places[y] < places[x] and one_edit(x, y) for y in lines)
    }
    out = []
    for d, text, *_ in data:
        if text is None:
            out.append((d, None))
            continue
        kept = []
        for k, line in enumerate(text.split("\n")):
            place = (float("inf") if d is None else d, k)
            if line not in places or (line not in near and places[line] == place):
                kept.append(line)
        out.append((d, "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    base = ["the quick brown fox jumps", "aaaaaaaaaaaaaaaaaaaa", "été 🙂 sur la grande place", "short", "abababababababababab", "page number 1 of the report"]
    data = [(None, "short\n\n  ", 1), (3, None, 2), (4, "", 3), (5, "the quick brown fox jumps", 4), (5, "the quick brown fox jumps", 4)]
    for d in rng.sample(range(10, 500), 60):
        lines = []
        for _ in range(rng.randint(1, 5)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at = rng.randrange(len(line) + 1)
                kind = rng.randrange(3)
                line[at : at + (kind > 0)] = [rng.choice("ab 🙂x")] if kind < 2 else []
            lines.append("".join(line))
        data.append((d, "\n".join(lines), d))
    docs = spark.createDataFrame(data, "doc_id bigint, text string, n_near int").repartition(3)
    found = dedup_lines(docs).collect()
    assert sorted(((r.doc_id, r.text) for r in found), key=repr) == brute(data)
    assert any(r.n_near for r in found)


def test_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a\na", "x"), (2, "y" * 200_000 + "\na", "z")], "doc_id bigint, text string, line string")
    rows = {r.doc_id: r for r in dedup_lines(docs).collect()}
    assert (rows[1].text, rows[1].line, rows[1].n_lines, rows[1].n_equal) == ("a", "x", 2, 1)
    assert rows[2].text == "y" * 200_000
    assert dedup_lines(docs.limit(0)).count() == 0
