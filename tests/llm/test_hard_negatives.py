"""Op 13 against all pairs; segment bounds against exact scores."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecraft.llm import op13_hard_negatives as hn


def brute(rows, anchor):
    use = [(i, r[0], r[2], [max(-hn.LIMIT, min(hn.LIMIT, math.floor(256 * float(x)))) for x in r[1]]) for i, r in enumerate(rows)
           if r[0] is not None and r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    out = []
    for i, vid, label, v in use:
        if not anchor(vid):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), o, j, lab) for j, o, lab, w in use if j != i and len(w) == len(v)]
        for s, o, _, _ in sorted(x for x in scored if x[3] == label)[:5]:
            near = sorted(x for x in scored if x[3] != label and 50 * -s <= 100 * -x[0] <= 95 * -s)[:3]
            out += [(vid, o, k + 1, n[1], -s, -n[0]) for k, n in enumerate(near)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id long, embedding array<double>, label int, segments string, row int").repartition(5)


def got(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("dim", [3, 16, 64, 70])
def test_bounds_hold(dim):
    rng = np.random.default_rng(dim)
    x = rng.integers(-256, 256, (80, dim)).astype(np.int64)
    block = hn.Block(np.arange(80), np.arange(80), np.zeros(80, int), x, hn.summary(x.astype(float)).astype("<f4"))
    exact, spread = x @ x.T, None
    for k in range(len(hn.SEGMENTS)):
        m, d = block.level(k)
        mid, rest = m @ m.T, d @ d.T + 1e-5 * np.outer(block.norms, block.norms) + 1e-3
        assert (np.abs(exact - mid) <= rest).all()
        assert spread is None or (rest <= spread * 1.001 + 1).all()       # finer cuts bound no worse
        spread = rest
    low = np.full(80, 3000.0 * dim)
    i, j = hn.candidates(block, block, np.ones((80, 80), bool), low, np.full(80, np.inf))
    assert set(zip(*np.nonzero(exact >= 3000 * dim))) <= set(zip(i, j))
    assert (hn.scores(block, block, i, j) == exact[i, j]).all()


@pytest.mark.parametrize("seed", range(3))
def test_whole_results(spark, seed):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, 24))
    rows = [(int(i), (centres[rng.integers(6)] + rng.standard_normal(24) * .5).round(2).tolist(), int(rng.choice(4, p=[.55, .15, .15, .15]))) for i in range(300)]
    anchor = F.col("vec_id") % 10 == 0
    want = brute(rows, lambda i: i % 10 == 0)
    assert want
    stored = hn.store_segments(frame(spark, rows))
    assert got(hn.hard_negatives(stored, anchor)) == want
    if not seed:
        assert got(hn.hard_negatives(stored, anchor, pass_bytes=4000)) == want          # many passes


def test_odd_rows(spark):
    base = [([1.0, .5, .2], 0), ([.9, .6, .1], 0), ([.9, .6, .1], 0), ([.7, .3, .2], 1), ([.7, .3, .2], 1), ([.6, .4, .1], 2), ([-1.0, -.5, -.2], 0), ([0.0, 0.0, 0.0], 1)]
    rows = [(k, v, lab) for k, (v, lab) in enumerate(base)] + [(0, [1.0, .5, .2], 0), (0, [.2, .9, .1], 0), (3, [.8, .3, .2], 1)]
    rows += [(20, None, 0), (21, [1.0, None, .2], 0), (22, [1.0, float("nan"), .2], 1), (23, [1.0, float("inf"), .2], 1), (24, [.9, .5, .2], None), (25, [], 0),
             (26, [1.0, .5], 0), (27, [.9, .6], 0), (28, [.7, .2], 1), (29, [1e300, -1e300, 1e-300], 3), (30, [1e5, 2.0, 3.0], 3), (31, [7e4, 2.0, 3.0], 2)]
    everyone = lambda i: True
    want = brute(rows, everyone)
    df = frame(spark, [*rows, (None, [1.0, .5, .2], 0)])
    assert got(hn.hard_negatives(hn.store_segments(df), F.lit(True))) == want
    assert got(hn.hard_negatives(hn.store_segments(df.limit(0)), F.lit(True))) == []
    assert got(hn.hard_negatives(hn.store_segments(df), F.lit(False))) == []
