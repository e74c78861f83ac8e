"""Exact quantiles by refined histograms and by value counts, against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecraft.operators import profile as pr
from ratecraft.operators import quantiles as qu
from ratecraft.operators.chartdata import box_stats

PROBS = (0.0, 0.25, 0.5, 0.75, 1.0)


def _close(got, want):
    return got == want or math.isclose(got, want, rel_tol=1e-12)


@pytest.mark.parametrize("seed", range(3))
def test_column_quantiles_many_shapes(spark, seed):
    rng = np.random.default_rng(seed)
    n = [1, 7, 5000][seed]
    cols = {"u": rng.random(n), "skew": np.exp(rng.normal(0, 60, n)), "few": rng.integers(0, 3, n).astype(float), "neg": -np.exp(rng.normal(0, 20, n)),
            "big": rng.choice([-1.7e308, 1.7e308, 0.0, 5e-324, -math.inf, math.inf], n, p=[.2, .2, .2, .2, .1, .1]), "ids": rng.permutation(n) * 1_000_003.0}
    df = spark.createDataFrame([(*map(float, r), "ab"[i % 2] if n > 1 else "a") for i, r in enumerate(zip(*cols.values()))], ", ".join(f"{c} double" for c in cols) + ", g string")
    got = qu.column_quantiles(df, {c: F.col(c) for c in cols}, PROBS, by="g")
    for g in "ab":
        for c, v in cols.items():
            own = np.sort(v["ab".index(g)::2] if n > 1 else v) if g == "a" or n > 1 else np.zeros(0)
            if not len(own):
                continue
            for q in PROBS:
                lo, hi, w = qu.places(len(own), [q])[q]
                want = own[lo] if own[lo] == own[hi] else own[lo] + (own[hi] - own[lo]) * w
                assert _close(got[g, c].quantiles[q], want) or (math.isnan(want) and math.isnan(got[g, c].quantiles[q])), (c, q)


def test_column_quantiles_of_nulls_and_ties(spark):
    df = spark.createDataFrame([(None, 1.0), (None, float("nan")), (None, 2.0), (None, 2.0), (None, 2.0), (None, None)], "a double, b double")
    got = qu.column_quantiles(df, {"a": F.col("a"), "b": F.col("b")}, (0.25, 0.5))
    assert got[None, "a"].quantiles == {0.25: None, 0.5: None} and got[None, "b"].quantiles == {0.25: 1.75, 0.5: 2.0}
    assert (got[None, "b"].n, got[None, "b"].n_missing, got[None, "b"].mean) == (4, 2, 1.75)
    assert qu.column_quantiles(df.limit(0), {"a": F.col("a")}, (0.5,)) == {}


def test_summary_where_a_sketch_would_be_off(spark):
    """400,000 distinct ids: a rank error of 1 / 100,000 of the rows would show."""
    df = spark.range(400_000).select((F.col("id") * 7919 % 400_009).alias("a"), F.when(F.col("id") % 10 != 0, F.col("id") * 1.5).alias("b"))
    rows = {r.column: r for r in pr.column_summary(df, ["a", "b"]).collect()}
    for c, x in (("a", np.arange(400_000) * 7919 % 400_009), ("b", np.array([i * 1.5 for i in range(400_000) if i % 10]))):
        assert [rows[c].q1, rows[c].median, rows[c].q3] == np.quantile(x, [.25, .5, .75]).tolist()
    assert pr.column_summary(df.limit(0), ["a"]).first().asDict() == {"column": "a", "n_na": 0, **dict.fromkeys(["min", "q1", "median", "mean", "q3", "max"])}
    assert rows["a"].n_na == 0 and rows["b"].n_na == 40_000 and rows["b"].min == 1.5


def test_grouped_quantiles_of_a_hot_group(spark):
    """One group with a million distinct values beside small, null and constant groups."""
    hot = spark.range(1_000_000).select(F.lit("hot").alias("g"), (F.col("id") * 1.0).alias("v"))
    rest = spark.createDataFrame([("s", 5.0), ("s", 1.0), ("s", 2.0), (None, 1.0), (None, 4.0), ("c", 3.0), ("c", 3.0), ("c", None), ("n", None)], "g string, v double")
    got = {r.g: tuple(r)[1:] for r in qu.grouped_quantiles(hot.unionByName(rest), "g", "v", (0.25, 0.5, 0.75), ("a", "b", "c")).collect()}
    assert got == {"hot": (1_000_000, 249999.75, 499999.5, 749999.25), "s": (3, 1.5, 2.0, 3.5), None: (2, 1.75, 2.5, 3.25), "c": (2, 3.0, 3.0, 3.0)}


def test_box_stats_against_numpy(spark):
    rng = np.random.default_rng(4)
    rows = [(int(g), float(v)) for g, v in zip(rng.integers(0, 5, 800), np.round(rng.lognormal(2, 1, 800)))]
    got = {r.g: r for r in box_stats(spark.createDataFrame(rows, "g int, v double"), "g", "v").collect()}
    for g in range(5):
        v = np.array([x for k, x in rows if k == g])
        q = np.quantile(v, [.25, .5, .75])
        lo, hi = q[0] - 1.5 * (q[2] - q[0]), q[2] + 1.5 * (q[2] - q[0])
        inside = v[(v >= lo) & (v <= hi)]
        assert np.allclose([got[g].q1, got[g].median, got[g].q3, got[g].whisker_low, got[g].whisker_high], [*q, inside.min(), inside.max()])
        assert (got[g].n, got[g].n_outliers) == (len(v), len(v) - len(inside))


def test_bitmap_counts(spark):
    ids = [0, 1, 1, 32767, 32768, 10**6, 10**6, -5, -32768, None, None]
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(4)
    assert pr.distinct_int_count(df, "id", "n").first().n == len(set(ids))
    assert pr.distinct_int_count(df.filter("id is not null"), "id", "n").first().n == len(set(ids)) - 1
    assert pr.distinct_int_count(df.limit(0), "id", "n").first().n == 0


def test_distinct_counts_expand_nothing(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "a"), (None, None)], "i long, s string")
    out = pr.distinct_counts(df, {"n_i": "i", "n_s": "s"})
    assert tuple(out.first()) == (3, 2)
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
