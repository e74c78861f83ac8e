"""The near-copy stage of the corpus pipeline goes by shingles of five words, the op5 query by two."""

import random
import re

import corpus_pipeline
from llm_fixtures import SF
from ratecraft.llm import op05_superminhash as mh
from test_dedup import brute_groups, text_sets


def sets_of(rows, size):
    out = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        out[i] = set(zip(*[w[k:] for k in range(size)])) if len(w) >= size else {tuple(w)} if w else set()
    return out


def kept_of(sets):
    return {i for i, r in brute_groups(sets).items() if i == r}


def test_stage_keeps_texts_that_differ_by_five_words(spark):
    """200 words with 3 or 8 scattered changes: both are near copies by pairs of words, only 3 are by five."""
    rng = random.Random(11)
    rows = []
    for g in range(20):
        base = [f"w{g}-{rng.randrange(10**6)}" for _ in range(200)]
        rows.append((10 * g, " ".join(base)))
        for k, changes in enumerate((3, 8, 8)):
            w = list(base)
            for at in range(5, 200, 200 // changes)[:changes]:
                w[at] = f"v{rng.randrange(10**6)}"
            rows.append((10 * g + k + 1, " ".join(w)))
    rows += [(1000, "one two three four"), (1001, "one two three four"), (1002, "one two three"), (1003, None), (1004, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pairs, fives = kept_of(text_sets(rows)), kept_of(sets_of(rows, 5))
    assert pairs < fives
    assert {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()} == fives
    assert {r.doc_id for r in mh.drop_duplicates(docs, 2).collect()} == pairs
    got = {r.doc_id: r.n_shingles for r in mh.near_duplicates(docs, 5).collect()}
    assert got == {i: len(s) for i, s in sets_of(rows, 5).items()}


def test_stage_equals_brute_force_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()}
    assert got == kept_of(sets_of(rows, 5)) != kept_of(text_sets(rows))
