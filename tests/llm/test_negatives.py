import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftgraph.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, anchor, positives=5, most=5, lowest=80, highest=100):
    part = [
        (i, v, label, [math.floor(256 * x) for x in e])
        for i, (v, e, label, *_) in enumerate(rows)
        if v is not None and label is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    cut = lambda x: min(max(x, -(1 << 63)), (1 << 63) - 1)
    found = []
    for i, v, label, e in part:
        if not anchor(v):
            continue
        scored = sorted((-cut(sum(map(int.__mul__, e, x))), w, j, other) for j, w, other, x in part if j != i and len(x) == len(e))
        for score, w, _, _ in [s for s in scored if s[3] == label][:positives]:
            fits = [s for s in scored if s[3] != label and lowest * -score <= 100 * -s[0] <= highest * -score][:most]
            found += [(v, w, rank, s[1], -score, -s[0]) for rank, s in enumerate(fits, 1)]
    return sorted(found)


@pytest.mark.parametrize(("scale", "size"), [(0.3, 64), (5, 7), (3e4, 9), (1e9, 5), (0.004, 3), (1, 0)])
def test_products_are_exact(scale, size):
    rng = np.random.default_rng(1)
    a, b = (np.floor(256 * scale * rng.standard_normal((n, size))) for n in (6, 37))
    want = [[min(max(sum(int(x) * int(y) for x, y in zip(r, s, strict=True)), -(1 << 63)), (1 << 63) - 1) for s in b] for r in a]
    assert negatives.packed_products(a, b).tolist() == want


@pytest.mark.parametrize("block", [100_000, 40])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(negatives, "TILE", 2_000)
    rng = random.Random(block)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = []
    for i in range(300):
        centre = rng.choice(centres)
        # Few different values, so that scores tie often.
        rows.append((i - 20, [round(2 * x + rng.gauss(0, 0.4)) / 8 for x in centre], rng.randrange(3)))
    rows += rows[:30] + [(7, [0.5] * 6, 9)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = negatives.hard_negatives(frame, F.col("vec_id") % 10 == 0, positives=4, negatives=3, lowest=70)
    assert sorted(map(tuple, found.collect())) == brute(rows, lambda v: v % 10 == 0, 4, 3, 70) != []


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    x, y = [0.5, 0.25], [0.4, 0.3]
    rows = [(0, x, 1), (0, x, 1), (1, x, 1), (2, y, 2), (3, y, 2), (3, y, 2), (None, y, 2), (100, x, None), (200, None, 1), (300, [nan, 1.0], 1)]
    rows += [(400, [inf, 1.0], 1), (500, [None, 1.0], 1), (600, [], 1), (601, [], 1), (602, [], 2), (700, [1.0], 3), (800, [-1e30, 1.0], 4), (801, [-1e30, 2.0], 4)]
    rows += [(802, [-1e30, 0.0], 5), (900, [0.0, 0.0], 6), (901, [0.0, 0.1], 6), (902, [0.1, 0.0], 7)]
    frame = spark.createDataFrame([(*r, 4, "x") for r in rows], SCHEMA + ", id int, row string")
    asked = F.col("vec_id") % 100 == 0
    found = sorted(map(tuple, negatives.hard_negatives(frame, asked).collect()))
    assert found == brute(rows, lambda v: v % 100 == 0)
    assert {r[0] for r in found} == {0, 600, 800, 900}
    assert negatives.hard_negatives(frame.limit(0), asked).count() == 0
    assert negatives.hard_negatives(frame, F.lit(None)).count() == 0


def test_many_copies(spark):
    same = spark.range(6000).selectExpr("id as vec_id", "array(float(0.5), float(1)) as embedding", "cast(id % 3 = 0 as int) as label")
    rows = negatives.hard_negatives(same, F.col("vec_id") == 0).collect()
    score = 128 * 128 + 256 * 256
    assert sorted(map(tuple, rows)) == [(0, p, rank, n, score, score) for p in (3, 6, 9, 12, 15) for rank, n in enumerate((1, 2, 4, 5, 7), 1)]
