"""Ops 4 and 5 against brute force, and the component routine they share."""

import random

import numpy as np
import pytest
from llm_fixtures import SF, long_text, no_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F

import __spark_entry__ as E
from ratecraft.llm import op04_collisions as vec
from ratecraft.llm import op05_superminhash as mh
from ratecraft.llm.common import components


def union(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)]
    edges += [(500 + i, 500) for i in range(80)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    got = {r.node: r.root for r in components(df, "t").collect()}
    want = union({x for e in edges for x in e}, edges)
    assert got == {n: r for n, r in want.items() if n != r}


def text_sets(rows):
    import re
    out = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        out[i] = set(zip(words, words[1:])) if len(words) > 1 else {tuple(words)} if words else set()
    return out


def brute_groups(sets):
    ids = sorted(i for i in sets if sets[i])
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return union(sets, links)


def test_minhash_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    sets = text_sets([(d.doc_id, d.text) for d in docs])
    roots = brute_groups(sets)
    rows = E.queries()["op5_minhash_dedup"](spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == \
        {i: (len(sets[i]), roots[i], roots[i] == i) for i in sets}


def test_minhash_chains_and_big_groups(spark):
    """Chains whose ends are not alike, and one group of near copies that needs the second pass and blocks."""
    rng = random.Random(4)
    base = [f"w{k}" for k in range(120)]
    rows, at = [], 0
    for _ in range(700):                         # near copies of one text, some not alike with each other
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10**6)}"
        rows.append((at, " ".join(w)))
        at += 1
    w = [f"c{k}" for k in range(150)]
    for k in range(25):                          # a drifting chain
        rows.append((at, " ".join(w)))
        at += 1
        for j in range(3):
            w[(6 * k + j) % 150] = f"d{k}-{j}"
    rows += [(at + k, f"lone text number {k} " + " ".join(str(rng.random()) for _ in range(10))) for k in range(30)]
    sets = text_sets(rows)
    want = brute_groups(sets)
    got = {r.doc_id: r.component_id for r in mh.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_minhash_estimate():
    rng = np.random.default_rng(0)
    pool = mh.mix64(np.arange(4000, dtype=np.uint64))
    for n in (3, 40, 900):
        errors = []
        for k in range(40):
            both = rng.choice(pool, 2 * n, replace=False)
            a, b = both[: int(1.5 * n)], both[int(.5 * n):]
            errors.append(np.mean(mh.superminhash(a) == mh.superminhash(b)) - len(set(a) & set(b)) / len(set(a) | set(b)))
        assert abs(np.mean(errors)) < .04


def test_minhash_odd_rows(spark, odd_docs, no_docs):
    rows = mh.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add((r.n_shingles, r.component_id, r.kept))
    assert by[1] == {(11, 1, True)} and by[2] == {(11, 1, False)}
    for i in (3, 4, 5):
        assert by[i] == {(0, i, True)}
    assert by[6] == {(1, 6, True)} and by[8] == {(1, 8, True)}
    assert by[None] == {(4, None, True), (0, None, True)}
    kept = mh.drop_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.filter("doc_id is not null").collect()) == [1, 3, 4, 5, 6, 7, 8, 9, 10, 11]
    assert kept.filter("doc_id is null").count() == 2
    assert mh.near_duplicates(no_docs).count() == 0


def test_long_texts_in_pieces(monkeypatch):
    text = " ".join(f"w{k % 977}" for k in range(30_000)) + " " + "y" * 5000
    raw = np.frombuffer(text.encode(), np.uint8)
    whole = mh.word_hashes(raw, np.array([0, len(raw)]))[0]
    monkeypatch.setattr(mh, "PIECE", 1000)
    assert np.array_equal(mh.word_hashes(raw, np.array([0, len(raw)]))[0], whole)


def brute_vectors(rows):
    ok = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        a = np.array(v, np.float64)
        if np.linalg.norm(a):
            ok.setdefault((label, len(v)), []).append((i, a / np.linalg.norm(a)))
    n, links = {}, []
    for group in ok.values():
        x = np.stack([a for _, a in group])
        s = np.einsum("ij,kj->ik", x, x)
        for p, q in zip(*np.nonzero(s >= .93)):
            if p != q:
                n[group[p][0]] = n.get(group[p][0], 0) + 1
                links.append((group[p][0], group[q][0]))
    return n, union({r[0] for r in rows if r[0] is not None}, links)


def test_vectors_with_planted_groups(spark, monkeypatch):
    """Near copies around centres (one group larger than a block), several labels, exact copies, scaled copies."""
    monkeypatch.setattr(vec, "CELL", 32)
    rng = np.random.default_rng(3)
    rows, at = [], 0
    for label, size in ((0, 700), (1, 60), (2, 5), (None, 6)):
        centre = rng.standard_normal(64)
        for k in range(size):
            v = centre + rng.standard_normal(64) * rng.uniform(0.05, 0.45)
            rows.append((at, (v * rng.uniform(.5, 2)).astype(np.float32).tolist(), label))
            at += 1
        rows += [(at + k, rng.standard_normal(64).astype(np.float32).tolist(), label) for k in range(300)]
        at += 300
    rows += [(at, rows[0][1], 0), (at + 1, rows[0][1], 0), (at + 2, rows[0][1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    n, root = brute_vectors(rows)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vec.link_vectors(df).collect()}
    assert got == {i: (n.get(i, 0), root[i], root[i] == i) for i, _, _ in rows}


def test_vector_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    n, root = brute_vectors(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in E.queries()["op4_vector_dedup"](spark, SF).collect()}
    assert got == {i: (n.get(i, 0), root[i]) for i, _, _ in rows}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, None, 0), (4, [], 0), (5, [0.0, 0.0], 0),
            (6, [nan, 1.0], 0), (7, [inf, 1.0], 0), (8, [None, 1.0], 0), (9, [1.0, 0.0, 0.0], 0), (None, [1.0, 0.0], 0),
            (10, [1.0, 0.0], None), (11, [1.0, -0.0], 0)]
    schema = "vec_id long, embedding array<float>, label int, rep string, links string, n_links string, key string"
    df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], schema)
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in vec.link_vectors(df).collect()), key=str)
    want = [(1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), (11, 3, 1, False), (None, 0, None, True)]
    want += [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10)]
    assert got == sorted(want, key=str)
    assert vec.link_vectors(df.limit(0)).count() == 0


def test_calibration():
    assert vec.required() <= vec.M and vec.tables_for(0) == 1
    rng = np.random.default_rng(1)
    x = rng.standard_normal(64)
    x /= np.linalg.norm(x)
    short = 0
    for _ in range(2000):
        y = rng.standard_normal(64)
        y -= (y @ x) * x
        y = .93 * x + np.sqrt(1 - .93 ** 2) * y / np.linalg.norm(y)
        d = rng.standard_normal((64, vec.M))
        short += np.sum(np.abs((x - y) @ d) <= vec.window()) < vec.required()
    assert short <= 2
