"""Op 12 against a plain scoring of every document."""

import random
import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest
from llm_fixtures import SF, long_text, no_docs, odd_docs  # noqa: F401

import __spark_entry__ as E
from ratecraft.llm import op12_treap_search as ts

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, k=50):
    terms = [TERM.findall((t or "").translate(LOWER)) for _, t in docs]
    n_docs, n_terms = sum(map(bool, terms)), sum(map(len, terms))
    tfs = [Counter(t) for t in terms]
    df = Counter(t for c in tfs for t in c)
    out = []
    for item, text in set(items):
        own = set(TERM.findall((text or "").translate(LOWER)))
        scored = []
        for (doc, _), tf, t in zip(docs, tfs, terms):
            score = 0
            for term in own & set(tf):
                w = floor(1000 * log((2 * n_docs + 2) / (2 * df[term] + 1)))
                score += w * ((1000000000 * tf[term]) // (1000 * tf[term] + 20 * (50 + (50 * len(t) * n_docs) // n_terms)))
            if score > 0:
                scored.append((-score, doc is None, doc))
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_tree_holds_its_cells(seed):
    rng = np.random.default_rng(seed)
    n = [1, 2, 500, 5000][seed]
    cells = np.unique(rng.integers(0, [900, 70], (n, 2)) if seed else np.array([[5, 3]]), axis=0)
    value = rng.integers(1, 10**6, len(cells))
    tree = ts.Tree(ts.encode_tree(cells[:, 0], cells[:, 1], value))
    at = tree.col >= 0
    assert sorted(zip(tree.row[at], tree.col[at], tree.top[at])) == sorted(zip(cells[:, 0], cells[:, 1], value))
    inner = np.flatnonzero(tree.mask)
    for i in inner:
        kids = np.arange(tree.first[i], tree.first[i] + bin(tree.mask[i]).count("1"))
        assert tree.top[kids].max() == tree.top[i]
    assert len(tree.mask) < 2 * len(cells) * max(1, tree.height)


def test_search_is_exact(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)] + ["é", "日本", "A1", "Zz"]
    docs = [(i, " ".join(rng.choices(words, weights=[1 / (j + 1) for j in range(len(words))], k=rng.randint(0, 80)))) for i in range(400)]
    docs += [(1000 + i, docs[5][1]) for i in range(60)]            # ties beyond the 50 that are returned
    items = [(j, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for j in range(25)] + [(90, docs[5][1]), (91, "w0"), (92, "unknown words"), (93, "W3 é a1")]
    d, q = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert got(ts.search(ts.build_index(d), q)) == want
    assert got(ts.search(ts.build_index(d, shard_tokens=300), q, item_bytes=400)) == want      # many shards, several passes
    assert got(ts.search(ts.build_index(d), q, k=3)) == brute(docs, items, 3)


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert got(E.queries()["op12_treap_search"](spark, SF)) == brute(docs, items)


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([("a", "dog WORD", 1), ("a", "dog WORD", 1), ("a", "id here", 1), (None, "fox", 1), ("n", None, 1), ("e", "", 1)],
                                  "item_id string, text string, rank int")
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = brute(docs, [(r.item_id, r.text) for r in items.collect()])
    assert got(ts.search(ts.build_index(odd_docs), items)) == want
    assert any(r[2] is None for r in want) and any(r[0] is None for r in want)
    assert ts.search(ts.build_index(no_docs), items).count() == 0
    assert ts.search(ts.build_index(odd_docs), items.limit(0)).count() == 0


def test_pruning_opens_few_ranges():
    rng = random.Random(1)
    shard = ts.ShardBuilder(4000, 80_000)
    for i in range(4000):
        shard.add(i, [b"t%d" % rng.randrange(2000) for _ in range(20)] + ([b"rare"] if i % 400 == 0 else []))
    row = shard.row()
    import zlib
    names = zlib.decompress(row["terms"]).split(b"\n")
    tree, res = ts.Tree(row["tree"]), ts.Results(5)
    opened = ts.descend(tree, np.array([names.index(b"rare")]), np.array([10]), np.frombuffer(row["docs"], "<i8"), res)
    assert len(res.score) == 5 and opened < 400
