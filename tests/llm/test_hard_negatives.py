"""Hard negatives against all scores, and intervals that hold every score."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tonescale.llm import hard_negatives as hn


def brute(rows: list[tuple], positives=5, negatives=3) -> list[tuple]:
    whole = []
    for i, label, vector in rows:
        if i is not None and label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            whole.append((i, label, tuple(math.floor(256 * x) for x in vector)))
    whole = sorted(set(whole))
    found = []
    for anchor in (r for r in whole if r[0] % 50 == 0):
        scored = sorted(
            ((sum(a * b for a, b in zip(anchor[2], r[2])), r) for r in whole if r[0] != anchor[0] and len(r[2]) == len(anchor[2])),
            key=lambda p: (-p[0], p[1][0]),
        )
        for score, positive in [p for p in scored if p[1][1] == anchor[1]][:positives]:
            fits = [p for p in scored if p[1][1] != anchor[1] and 50 * score <= 100 * p[0] <= 95 * score][:negatives]
            found += [(anchor[0], positive[0], rank, n[0], score, s) for rank, (s, n) in enumerate(fits, 1)]
    return sorted(found)


def mined(spark, rows: list[tuple], **sizes) -> list[tuple]:
    data = [(i, label, v, 1.5, "x") for i, label, v in rows]
    frame = spark.createDataFrame(data, "vec_id bigint, label int, embedding array<float>, vector double, anchor_key string")
    return sorted(map(tuple, hn.hard_negatives(frame, **sizes).collect()))


def single(values) -> list[float]:
    return [float(x) for x in np.asarray(values, np.float32)]


@pytest.mark.parametrize("size, sizes", [(64, {}), (7, {"rows_per_block": 40, "anchors_per_block": 2}), (100, {"rows_per_block": 100, "anchors_per_block": 1})])
def test_equals_brute_force(spark, size, sizes):
    draw = np.random.default_rng(size)
    centres = draw.standard_normal((6, size))
    rows = [(i, int(draw.integers(4)), single(centres[draw.integers(6)] + 0.4 * draw.standard_normal(size))) for i in range(400)]
    wanted = brute(rows)
    assert wanted and mined(spark, rows, **sizes) == wanted


def test_odd_rows(spark):
    rng = random.Random(3)
    near = [[rng.choice([0.5, 0.25, -0.5]) for _ in range(4)] for _ in range(12)]
    rows = [(i, i % 3, near[i % 12]) for i in range(150)]  # many ties
    rows += rows[:20] + [(50, 0, near[5]), (50, 1, near[5]), (51, 0, near[1])]  # repeated rows and ids
    rows += [(None, 1, near[0]), (200, None, near[0]), (201, 1, None), (202, 1, [None, 1.0, 1.0, 1.0]), (250, 1, [float("nan"), 1.0, 1.0, 1.0])]
    rows += [(203, 1, [float("inf")] * 4), (300, 1, []), (301, 1, []), (302, 2, []), (350, 1, [1.0, 2.0]), (351, 1, [2.0, 2.0]), (352, 0, [1.0, 1.0])]
    rows += [(400, 0, [0.0] * 4), (450, 5, near[2]), (500, 0, [3e6] * 4), (501, 0, [3e6 + 2, 3e6, 3e6, 3e6]), (502, 1, [2e6] * 4)]
    assert mined(spark, rows, rows_per_block=30, anchors_per_block=2) == brute(rows)


def test_scores_beyond_64_bits(spark):
    rows = [(0, 1, [3e38] * 3), (1, 1, [2e38] * 3), (2, 2, [1e38, -1e38, 0.0]), (3, 2, [1e25] * 3)]
    assert mined(spark, rows) == []  # the positive counts as 2^63 - 1, and so do scores above it


def test_no_rows(spark):
    assert mined(spark, []) == [] and mined(spark, [(50, None, [1.0])]) == []


@pytest.mark.parametrize("size", [1, 3, 64, 300])
def test_intervals_hold_the_scores(size):
    draw = np.random.default_rng(size)
    rows = np.floor(256 * draw.standard_normal((500, size)))
    rows[:5] = 0
    rows[5:9] *= 1e6
    packed, align, residual = hn.codes(rows)
    block = hn.Block.__new__(hn.Block)
    block.coded(packed.view(np.uint64), align)
    block.residual = residual
    everyone = slice(None)
    for anchor, query in zip(rows[::25], hn.Query.of(rows[::25])):
        low, high = query.bounds(block, everyone)
        scores = rows @ anchor
        assert (low <= scores).all() and (scores <= high).all()
        assert size != 64 or not anchor.any() or np.median(high[9:] - low[9:]) < 0.3 * (anchor @ anchor)
