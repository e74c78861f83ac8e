"""Windows of sorted projections: counts, recall at the limit, earlier tables."""

import numpy as np
import pytest

from ratecraft.llm import op04_collisions as vec
from test_dedup import brute_vectors


def pairs_at(rng, n, low, high, dim=64):
    x, y = rng.standard_normal((2, n, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y -= np.einsum("ij,ij->i", x, y)[:, None] * x
    y /= np.linalg.norm(y, axis=1)[:, None]
    c = rng.uniform(low, high, n)[:, None]
    return x, c * x + np.sqrt(1 - c ** 2) * y


def test_counts_equal_a_plain_comparison(monkeypatch):
    rng = np.random.default_rng(2)
    places = rng.integers(-30, 31, (300, vec.M)).astype(np.int8)
    got = vec.Sorted(places).counts(places[:40])
    near = np.abs(places[:40, None].astype(int) - places[None].astype(int)) <= vec.STEPS + 1
    assert (got == near[:, :, :vec.SORTED].sum(axis=2)).all()
    want = {(i, j) for i in range(40) for j in range(300) if i < j and near[i, j, :vec.SORTED].sum() >= 12 and near[i, j].sum() >= 24}
    monkeypatch.setattr(vec, "required", lambda m: 12 if m == vec.SORTED else 24)
    found = {(int(i), int(j)) for a, b in vec.candidates(places, np.arange(300), None) for i, j in zip(a, b) if i < 40}
    assert want and found == want


def test_recall_at_the_limit():
    """Of 20,000 pairs with a cosine of 0.93 to 0.94 at least 0.999 get enough collisions, whatever one window misses."""
    x, y = pairs_at(np.random.default_rng(5), 20_000, .93, .94)
    inside = np.abs(vec.places_of(x).astype(int) - vec.places_of(y).astype(int)) <= vec.STEPS + 1
    assert ((inside.sum(axis=1) >= vec.required(vec.M)) & (inside[:, :vec.SORTED].sum(axis=1) >= vec.required(vec.SORTED))).mean() >= .999
    assert (~inside[:, 0]).sum() > 100


@pytest.mark.parametrize("bits", [1, 5])
def test_tables_meet_most_pairs(bits):
    x, y = pairs_at(np.random.default_rng(bits), 20_000, .93, .94)
    tables = vec.tables_for(bits)
    assert (vec.codes_of(x, bits, tables) == vec.codes_of(y, bits, tables)).any(axis=1).mean() >= .999
    assert (vec.codes_of(x, bits, 3) == vec.codes_of(x, bits, tables)[:, :3]).all()


def test_blocks_and_tables_find_what_all_pairs_find(spark, monkeypatch):
    """2,000 planted pairs in one label, dealt into many cells."""
    monkeypatch.setattr(vec, "CELL", 256)
    x, y = pairs_at(np.random.default_rng(8), 2000, .93, .94)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(np.concatenate([x, y]))]
    got = {r.vec_id: (r.n_links, r.component_id) for r in vec.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    n, root = brute_vectors(rows)
    missed = [i for i in root if got[i] != (n.get(i, 0), root[i])]
    assert len(missed) <= 4


def test_ids_that_stand_for_several_vectors(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [.99, .01], 0), (3, [.01, .99], 0), (4, [1.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in vec.link_vectors(df).collect())
    assert got == [(1, 1, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 1, 1, False), (4, 2, 1, False)]


def test_very_large_and_very_small_components(spark):
    rows = [(1, [1e200, 0.0], 0), (2, [1e200, 1e198], 0), (3, [1e-200, 0.0], 0), (4, [2e-200, 0.0], 0), (5, [0.0, 1e308], 0), (6, [0.0, 5e-324], 0), (7, [-1e308, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vec.link_vectors(df).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (1, 5), 6: (1, 5), 7: (0, 7)}
