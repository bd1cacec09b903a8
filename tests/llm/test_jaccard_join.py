"""Components against brute force over all pairs."""

import random

import pytest

from tonescale.llm import jaccard_join
from tonescale.llm.components import connected


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words)} if len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(data):
    sets = [shingles(t) for _, t in data]
    parent = list(range(len(data)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    best = {}
    for i, (d, _) in enumerate(data):
        r = root(i)
        best[r] = min((x for x in (best.get(r), d) if x is not None), default=None)
    return sorted(((d, len(s), best[root(i)] if s else d) for i, ((d, _), s) in enumerate(zip(data, sets))), key=repr)


def near_copies(seed):
    """Families of edited copies, common lines, exact copies, short and empty texts."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 5000)}"
    lines = [" ".join(word() for _ in range(12)) for _ in range(3)]
    texts = [None, "", " \t\n", "a b", "A  b", "a b c", "one two three four five"]
    for family in range(12):
        base = [word() for _ in range(rng.choice([30, 60, 120, 200]))]
        for _ in range(rng.choice([2, 5, 70])):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy) + " " + rng.choice(lines) * rng.randint(0, 1))
        texts += [texts[-1]] * rng.randint(0, 4)
    texts += [" ".join([*lines, word()]) for _ in range(20)]
    rng.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed, common, small, block", [(1, 16, 48, 1024), (2, 3, 4, 5), (3, 1000, 2, 3)])
def test_against_brute_force(spark, monkeypatch, seed, common, small, block):
    for name, value in (("COMMON", common), ("SMALL", small), ("BLOCK", block), ("PIVOTS", min(8, small - 1))):
        monkeypatch.setattr(jaccard_join, name, value)
    data = near_copies(seed)
    docs = spark.createDataFrame(data, "doc_id bigint, text string").repartition(3)
    assert sorted(map(tuple, jaccard_join.jaccard_components(docs).collect()), key=repr) == brute(data)


def test_missing_and_repeated_ids(spark):
    text = " ".join(f"x{i}" for i in range(40))
    data = [(None, text, 1), (7, text, 2), (7, text, 2), (5, text + " y", 3), (None, None, 4), (9, None, 5), (None, "z", 6)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, component_id int")
    rows = sorted(map(tuple, jaccard_join.jaccard_components(docs).collect()), key=repr)
    assert rows == sorted([(None, 36, 5), (7, 36, 5), (7, 36, 5), (5, 37, 5), (None, 0, None), (9, 0, 9), (None, 1, None)], key=repr)
    assert jaccard_join.jaccard_components(docs.limit(0)).count() == 0


def test_long_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 999), (5, 5)], "a bigint, b bigint")
    found = {r.node: r.label for r in connected(links).collect()}
    assert found == {**{i: 0 for i in range(201)}, 999: 999, 1000: 999}


def test_partners_equal_all_pairs():
    import numpy as np

    rng = np.random.default_rng(3)
    for size in (1, 2, 3, 17, 60):
        for _ in range(40):
            n = rng.integers(1, 60, size)
            spots = (n << 31) | rng.integers(0, n // 5 + 1)
            pairs = jaccard_join.possible(spots[:, None], spots[None, :]) & ~np.eye(size, dtype=bool)
            assert (jaccard_join.has_partner(spots) == pairs.any(axis=1)).all()


def test_only_the_commonest_shingles_reach_the_driver(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    collected = []

    def collect(frame, plain=DataFrame.collect):
        rows = plain(frame)
        collected.append(sum(len(r["keys"]) for r in rows if "keys" in r))
        return rows

    monkeypatch.setattr(jaccard_join, "COMMON", 2)
    monkeypatch.setattr(jaccard_join, "MOST_COMMON", 200)
    monkeypatch.setattr(DataFrame, "collect", collect)
    texts = [" ".join(f"a{i}" for i in range(104))] * 9 + [" ".join(f"b{i}" for i in range(2004))] * 3
    known = jaccard_join.frequencies(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    assert sum(collected) < 8 * 300
    assert (known.counts == 9).sum() == 100 and 50 < (known.counts == 3).sum() < 150
    assert (known.common[1:] > known.common[:-1]).all()


@pytest.mark.parametrize("seed, block", [(1, 1024), (2, 3)])
def test_second_round_compares_different_labels_only(spark, monkeypatch, seed, block):
    """A connected family of one group is dealt nowhere; other pairs are those of brute force."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rng, dealt, plain = random.Random(seed), [], jaccard_join.crossed
    members = [(g, 100 * g + i) for g in range(4) for i in range((1, 3, 9, 30)[g])]
    labels = {c: rng.choice([100, 200]) if g in (1, 2) else 300 for g, c in members}  # groups 0 and 3 are connected
    found = [(0, 0, 3, 0), (0, 1, 2, 0), (0, 0, 1, 0), (1, 77, 2, 10 << 31), (1, 77, 3, 10 << 31)]
    expected = {(a, b) for g, a in members for h, b in members if labels[a] != labels[b] and a < b and (g == h or (g, h) in {(0, 1), (1, 2), (2, 3)})}

    def crossed(rows):
        dealt.extend(rows.select("kind", "token", "other").distinct().collect())
        return plain(rows)

    monkeypatch.setattr(jaccard_join, "crossed", crossed)
    pairs = jaccard_join.second_round(
        spark.createDataFrame(found, "kind int, a bigint, b bigint, spot bigint"),
        spark.createDataFrame(members, "group_id bigint, class_id bigint"),
        spark.createDataFrame(list(labels.items()), "node bigint, label bigint"),
        spark.createDataFrame([], "a bigint, b bigint"),
    )
    assert sorted(map(tuple, pairs.collect())) == sorted(expected)
    assert (1, 3, 3) not in set(map(tuple, dealt)) and (2, 0, 3) not in set(map(tuple, dealt))


def test_sketches_leave_out_no_pair_that_links():
    import numpy as np

    rng = np.random.default_rng(5)
    sets, base = [], rng.integers(0, 1 << 63, 9000, dtype=np.uint64)
    for size in (1, 4, 15, 16, 17, 150, 9000):
        for _ in range(12):
            kept = base[:size][rng.random(size) < 0.9]
            sets.append(np.unique(np.concatenate([kept, rng.integers(0, 1 << 63, rng.integers(1, 2 + size // 6), dtype=np.uint64)])))
    sizes = np.array([len(s) for s in sets])
    i, j = (x.ravel() for x in np.indices((len(sets), len(sets))))
    common = np.array([len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)])
    similar = 100 * common >= 80 * (sizes[i] + sizes[j] - common)
    sketches = [jaccard_join.sketch(s) for s in sets]
    allowed = jaccard_join.linkable(sketches, sizes, i, j)
    assert allowed[similar].all() and not allowed.all()
    far = 100 * common < 70 * (sizes[i] + sizes[j] - common)
    assert allowed[far & (sizes[i] > 100) & (sizes[j] > 100)].sum() == 0
    assert jaccard_join.linkable([b"", b"\xff" * 8], np.array([3, 90]), np.array([0]), np.array([1])).all()


def test_joining_links_hold_the_same_labels_together():
    import numpy as np

    rng = np.random.default_rng(9)
    a, b = rng.integers(0, 60, 70), rng.integers(60, 120, 70)
    kept = jaccard_join.joining(np.r_[a, a], np.r_[b, b])

    def parts(x, y):
        label = {v: v for v in range(120)}
        for _ in range(120):
            for p, q in zip(x, y):
                label[p] = label[q] = min(label[p], label[q])
        return label

    x, y = np.r_[a, a][kept], np.r_[b, b][kept]
    assert parts(x, y) == parts(a, b) and len(kept) == 120 - len(set(parts(a, b).values()))
    assert len(jaccard_join.joining(np.empty(0, np.int64), np.empty(0, np.int64))) == 0


def test_similar_sets_equal_all_pairs(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 30, rng.integers(20, 90))).astype(np.uint64) for _ in range(25)] + [np.empty(0, np.uint64)]
    i, j = (x.ravel() for x in np.indices((26, 26)))
    common = np.array([len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)])
    sizes = np.array([len(s) for s in sets])
    expected = (100 * common >= 80 * (sizes[i] + sizes[j] - common)) | (sizes[i] == 0) | (sizes[j] == 0)
    for compared in (8, 1 << 10, 1 << 24):
        monkeypatch.setattr(jaccard_join, "COMPARED", compared)
        assert (jaccard_join.similar(sets, i, j) == expected).all()
