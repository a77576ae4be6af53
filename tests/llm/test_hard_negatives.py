import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from calltide.llm import hard_negatives as hn

SCHEMA = "id long, label int, v array<double>, row long, q string, score int, slice int"


def brute(rows, scale=256, positives=5, negatives=10, percents=(30, 90)):
    clean = []
    for k, (i, label, v) in enumerate(rows):
        if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            clean.append((k, i, label, [int(np.floor(scale * x)) for x in v]))
    out = []
    for a in clean:
        if a[1] is None or a[1] % 10:
            continue
        scored = [(-sum(x * y for x, y in zip(a[3], b[3])), b[1] is None, b[1] or 0, b[0], b) for b in clean if b[0] != a[0]]
        scored.sort()
        same = [s for s in scored if s[4][2] == a[2]][:positives]
        for p in same:
            fit = [n for n in scored if n[4][2] != a[2] and percents[0] * -p[0] <= 100 * -n[0] <= percents[1] * -p[0]]
            out += [(a[1], p[4][1], r + 1, n[4][1], -p[0], -n[0]) for r, n in enumerate(fit[:negatives])]
    return sorted(out, key=str)


def mined(spark, rows, **how):
    df = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA)
    return sorted(map(tuple, hn.mine_negatives(df, "id", "label", "v", F.col("id") % 10 == 0, **how).collect()), key=str)


@pytest.mark.parametrize("dims", [3, 8, 21])
def test_scores_are_inner_products(dims):
    rng = np.random.default_rng(dims)
    wide = -(-dims // 8) * 8
    a, b = np.zeros((7, wide), np.int64), np.zeros((50, wide), np.int64)
    a[:, :dims], b[:, :dims] = rng.integers(-300, 300, (7, dims)), rng.integers(-256, 256, (50, dims))
    planes = hn.to_planes(b, 9)
    got = hn.scores(hn.subset_sums(a, np.int32), planes.transpose(1, 2, 0).astype(np.intp))
    assert (got == b @ a.T).all()


def vectors(seed, n, dims=12, grid=3):
    rng = random.Random(seed)
    return [(i, rng.randrange(4), [rng.randint(-1, grid) / 8 for _ in range(dims)]) for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(hn, "SIDE", 3)
    monkeypatch.setattr(hn, "BATCH", 16)
    monkeypatch.setattr(hn, "TABLE_BYTES", 20_000)  # several groups of anchors
    rows = vectors(seed, 90)
    rows += [(100 + i, 1, rows[3][2]) for i in range(40)] + [(200 + i, 2, rows[3][2]) for i in range(40)]  # a common vector
    got = mined(spark, rows)
    assert got == brute(rows) and got


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(9, 40) + [
        (None, 0, [0.5] * 12), (None, 1, [0.5] * 12), (50, None, [0.1] * 12), (60, 1, None), (70, 1, [nan] + [0.1] * 11),
        (80, 1, [0.1, None]), (90, 2, [-inf]), (100, 2, []), (110, 3, [0.25] * 5), (120, 1, [1000.5] * 12), (130, 77, [0.5] * 12),
    ]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, rows, positives=2, negatives=3, percents=(10, 100)) == brute(rows, 256, 2, 3, (10, 100))
    assert mined(spark, []) == [] and mined(spark, [(1, 1, [0.5])]) == [] and mined(spark, [(10, 1, [0.5])]) == []


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(10, 1, [1.0, 0.0]), (10, 1, [1.0, 0.0]), (11, 2, [0.5, 0.0])]
    assert mined(spark, rows) == [(10, 10, 1, 11, 65536, 32768)] * 2
