"""Near-duplicate vectors against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tonescale.llm import embedding_dedup
from tonescale.llm.embedding_dedup import passes_for, vector_components
from tonescale.llm.vectors import units


def brute(rows: list[tuple]) -> list[tuple]:
    able = [
        label is not None and v is not None and len(v) > 0 and any(v) and all(x is not None and math.isfinite(x) for x in v)
        for _, label, v in rows
    ]
    unit = [units(np.array([v], np.float64))[0] if ok else None for ok, (_, _, v) in zip(able, rows)]
    component, links = list(range(len(rows))), [0] * len(rows)
    pairs = []
    for i in range(len(rows)):
        for j in range(i):
            if able[i] and able[j] and rows[i][1] == rows[j][1] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.93:
                pairs.append((i, j))
                links[i] += 1
                links[j] += 1
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            low = min(component[i], component[j])
            changed |= component[i] != component[j]
            component[i] = component[j] = low
    least = {}
    for c, (i, _, _) in zip(component, rows):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    return sorted(((r[0], n, least.get(c), r[0] is not None and r[0] == least.get(c)) for r, n, c in zip(rows, links, component)), key=repr)


def found(spark, rows: list[tuple], **options) -> list[tuple]:
    data = [(i, label, v, 0, b"k") for i, label, v in rows]
    frame = spark.createDataFrame(data, "vec_id bigint, label int, embedding array<float>, component_id int, key binary")
    return sorted(map(tuple, vector_components(frame, **options).collect()), key=repr)


def family(draw, size: int, members: int, noise: float, first: int, label: int) -> list[tuple]:
    centre = draw.standard_normal(size)
    centre /= np.linalg.norm(centre)
    near = centre + noise * draw.standard_normal((members, size)) / math.sqrt(size)
    return [(first + i, label, [float(x) for x in v.astype(np.float32) * np.float32(draw.uniform(0.1, 9))]) for i, v in enumerate(near)]


@pytest.mark.parametrize("cell", [1024, 32])
def test_families_beyond_window_and_cell(spark, monkeypatch, cell):
    monkeypatch.setattr(embedding_dedup, "CELL", cell)
    draw = np.random.default_rng(cell)
    rows = family(draw, 32, 150, 0.1, 1000, 1) + family(draw, 32, 120, 0.26, 2000, 1) + family(draw, 32, 100, 0.35, 3000, 2)
    rows += family(draw, 32, 100, 4.0, 4000, 1) + family(draw, 16, 40, 0.1, 5000, 1)
    rows += [(7000 + i, 1, rows[0][2]) for i in range(60)] + [(900, 2, rows[0][2])]
    wanted = brute(rows)
    assert sum(r[1] for r in wanted) > 20_000
    assert found(spark, rows, window=8, recall=0.9999) == wanted


def test_chain_wider_than_the_bound(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CELL", 8)
    rows = [(i, 3, [math.cos(i / 20), math.sin(i / 20), 0.0]) for i in range(60)]
    assert found(spark, rows, window=4) == brute(rows)


def test_odd_rows(spark):
    one, two = [1.0, 2.0, 3.0], [2.0, 4.0, 6.0]
    rows = [(5, 1, one), (5, 1, one), (3, 1, two), (None, 1, one), (4, 2, one), (6, None, one), (7, None, one), (8, 1, None), (9, 1, [0.0] * 3)]
    rows += [(10, 1, [0.0] * 3), (11, 1, []), (12, 1, []), (13, 1, [float("nan"), 1.0, 1.0]), (14, 1, [float("inf")] * 3), (15, 1, [None, 1.0, 1.0])]
    rows += [(None, 7, two), (None, 7, one), (16, 8, [1e38] * 3), (17, 8, [1e-38] * 3), (18, 9, [1.0, 2.0]), (None, None, None)]
    rows += [(20, 4, [-0.0, 1.0]), (21, 4, [0.0, 1.0])]
    assert found(spark, rows) == brute(rows)


def test_no_rows(spark):
    assert found(spark, []) == [] and found(spark, [(1, None, None)]) == [(1, 0, 1, True)]


def test_number_of_passes():
    assert passes_for(10) == 4 and passes_for(10**9) > passes_for(10**6) > passes_for(10**3)
    assert passes_for(10**6, window=1024) < passes_for(10**6)


def test_recall_at_the_bound(spark):
    """Pairs just above the least similarity among many other vectors."""
    draw = np.random.default_rng(5)
    rows, angle = [], math.acos(0.9305)
    for i in range(400):
        a, b = np.linalg.qr(draw.standard_normal((24, 2)))[0].T
        rows += [(2 * i, 1, a.tolist()), (2 * i + 1, 1, (math.cos(angle) * a + math.sin(angle) * b).tolist())]
    rows += [(10_000 + i, 1, v.tolist()) for i, v in enumerate(draw.standard_normal((1500, 24)))]
    got = dict((r[0], r[1]) for r in found(spark, rows, window=16, recall=0.99))
    assert sum(got[2 * i] > 0 for i in range(400)) >= 0.98 * 400
