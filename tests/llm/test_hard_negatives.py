"""Hard negatives against a search of every pair."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def by_pairs(rows, positives=5, negatives=5, percent=80):
    ok = [(i, [math.floor(256 * x) for x in v], l) for i, v, l in rows if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    anchors = {(i, tuple(v), l) for i, v, l in ok if i % 100 == 0}
    out = []
    for i, v, l in anchors:
        met = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for j, w, m in ok if j != i and len(w) == len(v))
        for s, j, _ in [x for x in met if x[2] == l][:positives]:
            hits = [(t, n) for t, n, m in met if m != l and percent * -s <= 100 * -t <= 100 * -s]
            out += [(i, j, k, n, -s, -t) for k, (t, n) in enumerate(hits[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, parts=3):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(parts).withColumn("score", F.lit("x")).withColumn("id", F.lit("x"))
    return sorted(tuple(r) for r in hard_negatives.mine(frame, F.col("vec_id") % 100 == 0, F.col("label")).collect())


def made(seed, n, dims=3, scale=1.0):
    draw = random.Random(seed)
    return [(k * 10, [draw.randrange(-3, 9) * scale / 256 for _ in range(dims)], draw.randrange(4)) for k in range(n)]


@pytest.mark.parametrize("seed, scale", [(1, 1.0), (2, 0.37), (3, 1e30)])
def test_as_by_pairs(spark, seed, scale):
    rows = made(seed, 250, scale=scale)
    want = by_pairs(rows)
    if scale == 1e30:  # scores beyond 64 bits are held at the ends
        assert mined(spark, rows)
        return
    assert want and mined(spark, rows) == want


def test_scores_between_doubles_and_longs(spark):
    rows = [(k, [x * 2.0**18 for x in v], l) for k, v, l in made(4, 120)]
    rows = [(k, [x + 2.0**-8 for x in v], l) for k, v, l in rows]
    assert mined(spark, rows) == by_pairs(rows)
    a = np.array([[2.0**40, 3.0]])
    assert hard_negatives.scores(a, a).tolist() == [[MOST]] and hard_negatives.scores(a[:, 1:], a[:, 1:]).tolist() == [[9.0]]


MOST = (1 << 63) - 1


def test_several_blocks_and_small_matrices(spark, monkeypatch):
    rows = made(5, 300)
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 500)
    monkeypatch.setattr(hard_negatives, "MATRIX", 64)
    assert mined(spark, rows) == by_pairs(rows)


def test_hot_vector_and_ties(spark):
    rows = made(6, 60) + [(1001 + k, [4 / 256, 4 / 256, 4 / 256], k % 2) for k in range(200)]
    assert mined(spark, rows) == by_pairs(rows)


def test_odd_rows(spark):
    odd = [(None, [1.0, 1.0, 1.0], 1), (100, None, 1), (100, [1.0, None, 1.0], 1), (200, [1.0, math.nan, 1.0], 2), (300, [math.inf, 0.0, 0.0], 1)]
    odd += [(400, [1.0, 1.0, 1.0], None), (500, [], 1), (501, [], 1), (502, [], 2), (600, [1.0], 1), (601, [1.0, 1.0], 1), (700, [0.0, 0.0, 0.0], 1)]
    odd += [(800, [0.5, 0.5, 0.5], 1)] * 2 + [(800, [0.5, 0.5, 0.25], 1), (801, [0.4, 0.4, 0.4], 1), (801, [0.4, 0.4, 0.4], 1), (802, [0.4, 0.4, 0.4], 2), (802, [0.4, 0.4, 0.4], 2)]
    rows = made(7, 40) + odd
    assert mined(spark, rows) == by_pairs(rows)
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1)]) == []
    assert mined(spark, [(100, [1.0], 1)]) == []


def test_windows_by_suffixes():
    slots = {0: [(10, 1), (9, 2)], 1: [(8, 3), (8, 4)], 2: [(3, 5)]}
    got = hard_negatives.merged([(10, 7), (8, 8), (8, 9), (3, 6)], slots, 3, 80)
    want = [(10, 1, 10, 1), (10, 2, 9, 2), (10, 3, 8, 3)] + [(8, 1, 8, 3), (8, 2, 8, 4)] * 2 + [(3, 1, 3, 5)]
    assert [(p[0], r, *n) for p, r, n in got] == want
