"""Ops 2, 3, 6, 7 and 10: brute force, held-out accuracy and odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter
from math import log2

import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import SF, SF01, long_text, no_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
from ratecraft.llm import op02_language as lang
from ratecraft.llm import op03_licenses as lic
from ratecraft.llm import op06_edit_counts as edits
from ratecraft.llm import op07_decontam as deco
from ratecraft.llm import op10_toxicity as tox
from ratecraft.llm.wordgrams import rolling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def fold(doc_id, m):
    return zlib.crc32(str(doc_id).encode()) % m


# op 2

def test_language_query(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    rows = E.queries()["op2_language_id"](spark, SF01).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held) > .97


def brute_kneser_ney(counts, size):
    """Interpolated Kneser-Ney on plain dicts: counts of words -> function (context, character) -> probability."""
    grams = [Counter() for _ in range(size + 1)]
    for word, k in counts.items():
        marked = "\x02" + word + "\x03"
        for n in range(1, size + 1):
            for i in range(len(marked) - n + 1):
                grams[n][marked[i:i + n]] += k
    level = []
    for n in range(1, size + 1):
        c = {}
        for g, k in grams[n].items():
            if g != "\x02":
                left = sum(h[1:] == g for h in grams[n + 1]) if n < size else 0
                c[g] = k if n == size or g[0] == "\x02" else max(left, 1)
        n1, n2 = (sum(v == x for v in c.values()) for x in (1, 2))
        level.append((c, n1 / (n1 + 2 * n2) if n1 and n2 else .5))
    alphabet = max(256, 2 * len(grams[1]))

    def p(context, char):
        c, d = level[len(context)]
        own = {g: v for g, v in c.items() if g[:-1] == context}
        total = sum(own.values())
        if not context:
            return max(own.get(char, 0) - d, 0) / total + d * len(own) / total / alphabet
        if not own:
            return p(context[1:], char)
        return max(own.get(context + char, 0) - d, 0) / total + d * len(own) / total * p(context[1:], char)
    return p


LANG_WORDS = {"en": "banana bandana an anna bandit nab a tan band and tab", "xx": "ana bab dnd tan"}


def language_model(spark, monkeypatch, **limits):
    for k, v in limits.items():
        monkeypatch.setattr(lang, k, v)
    docs = spark.createDataFrame([(i, " ".join(random.Random(i).choices(LANG_WORDS[x].split(), k=9)), x) for i in range(60) for x in LANG_WORDS],
                                 "doc_id long, text string, lang string")
    model = lang.fit(docs)
    sample = lang.training_sample(docs).filter(F.col("part") >= lang.CALIBRATE).collect()
    return model, {x: Counter(w for r in sample if r.lang == x for w in r.text.split()) for x in LANG_WORDS}


def test_language_model_equals_plain_kneser_ney(spark, monkeypatch):
    model, counts = language_model(spark, monkeypatch)
    words = ["banana", "tan", "b", "dan", "zebra", "nabz", "é", "abandon"]
    bits = model.word_bits(words)
    for k, x in enumerate(sorted(LANG_WORDS)):
        p = brute_kneser_ney(counts[x], lang.ORDER)
        for w, got in zip(words, bits[:, k]):
            marked = "\x02" + w + "\x03"
            want = sum(log2(p(marked[max(0, i - lang.ORDER + 1):i], marked[i])) for i in range(1, len(marked)))
            assert got == pytest.approx(want, rel=1e-5), (x, w)


@pytest.mark.parametrize("keep", [10**6, 5, 0])
def test_language_probabilities_sum_to_one(spark, monkeypatch, keep):
    """Also after pruning, the next-character probabilities after any context sum to one with those of unseen characters."""
    model, _ = language_model(spark, monkeypatch, MOST_ENTRIES=keep)
    assert sum(np.diff(model.first)) <= 2 * (40 + keep) or keep > 100
    for k, x in enumerate(sorted(LANG_WORDS)):
        seen = sorted({c for w in LANG_WORDS[x].split() for c in w} | {"\x03"})
        alphabet = max(256, 2 * (len(seen) + 1))
        for context in ("", "b", "ba", "ban", "zz", "\x02", "\x02b"):
            bits = lambda c: symbol_bits(model, k, context + c)  # noqa: E731,B023
            total = sum(2.0 ** bits(c) for c in seen) + (alphabet - len(seen)) * 2.0 ** bits("\u4e00")
            assert total == pytest.approx(1, abs=2e-4), (x, context)


def symbol_bits(model, k, text):
    """log2 probability of the last character after the others in language ``k``, by plain recursion."""
    cps = np.array([*map(ord, text)], np.uint64)

    def entry(part):
        h = rolling(part, np.array([0, len(part)]), len(part))[0][0]
        at = int(np.searchsorted(model.grams, h))
        if at < len(model.grams) and model.grams[at] == h:
            return next((e for e in range(model.first[at], model.first[at + 1]) if model.lang[e] == k), None)
        return None

    bits = float(model.unknown[k])
    for n in range(1, min(lang.ORDER, len(cps)) + 1):
        at, context = entry(cps[-n:]), entry(cps[-n:-1]) if n > 1 else None
        if at is not None:
            bits = float(model.logp[at])
        elif context is not None:
            bits += float(model.backoff[context])
    return bits


def test_uneven_languages_keep_an_equal_share(spark, monkeypatch):
    """Twenty languages, some with a fiftieth of the others' documents: the rare ones are told apart as well."""
    rng = random.Random(12)
    words = {f"l{k:02d}": ["".join(rng.choices("abcdefghijklmnop", weights=[rng.random() ** 3 for _ in range(16)], k=rng.randint(2, 7))) for _ in range(60)] for k in range(20)}
    def text(x, n):
        return " ".join(rng.choices(words[x], k=n))
    rows = [(x, text(x, 40)) for k, x in enumerate(words) for _ in range(6 if k % 3 == 0 else 120)]
    docs = spark.createDataFrame([(i, t, x) for i, (x, t) in enumerate(rows)], "doc_id long, text string, lang string").repartition(4)
    monkeypatch.setattr(lang, "MAX_ENTRIES", 20 * 600)
    model = lang.fit(docs)
    per = np.bincount(model.lang, minlength=20)
    assert per.max() <= 600 + 16 * 16 + 40 and per.min() > 100
    asked = [(x, text(x, 30)) for x in words for _ in range(5)]
    got = lang.predict(spark.createDataFrame([(i, t, x) for i, (x, t) in enumerate(asked)], "doc_id long, text string, want string"), model).collect()
    assert sum(r.lang_pred == r.want for r in got) >= 97


def test_language_odd_rows(spark, odd_docs, no_docs):
    model = lang.fit(odd_docs)
    rows = lang.predict(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        letters = r.text is not None and any(c.isalpha() for c in r.text)
        assert (r.lang_pred == "und") == (not letters) and (letters or r.score == 0)
    empty = lang.fit(no_docs)
    assert lang.predict(no_docs, empty).count() == 0
    assert {r.lang_pred for r in lang.predict(odd_docs, empty).collect()} == {"und"}


def test_language_rejects_what_it_does_not_know(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    model = lang.fit(docs.select("doc_id", "text", "lang"))
    assert 0 <= model.accept <= 1 and model.slope > 0


# op 3

def test_license_query_base(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = E.queries()["op3_license_scan"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        w = words(docs[r.doc_id])
        at = [(i, label) for phrase, label in lic.BASE for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
        labels = sorted({x for _, x in at})
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(at), ",".join(labels))
        assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert set(labels) <= set(r.labels.split(",") if r.labels else []) and 0 <= r.score <= 1


@pytest.mark.parametrize("text,labels", [
    ("Released under the MIT License.", "mit"),
    ("SPDX-License-Identifier: Apache-2.0", "apache"),
    ("licensed under the GNU General Public License, version 3.0 or later", "gpl,gpl-3-0"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit"),
    ("CC BY-NC-SA 4.0", "cc-by-nc-sa"),
    ("wir gehen mit Lizenz nach Hause", ""),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
])
def test_license_rules(text, labels):
    assert lic.Scanner().scan(text)["labels"] == labels


def test_license_prefilter_and_suppression_lose_nothing():
    """Keyword gating finds what running every rule finds; suppression equals a quadratic check."""
    rng, scanner = random.Random(2), lic.Scanner()
    assert len(scanner.rules) > 300
    pieces = ["mit license", "the", "gnu general public license version 2", "licensed under the", "apache license version 2 0",
              "copyright c 2019 someone", "all rights reserved", "cc by sa 4 0", "public domain", "spdx license identifier mit"]
    for _ in range(200):
        line = f" {' '.join(rng.choices(pieces, k=8))} "
        found = [(m.start(), m.end(), r) for r in scanner.rules for m in r.pattern.finditer(line)]
        found.sort(key=lambda d: (-d[2].priority, d[0] - d[1], d[0], d[2].label))
        kept = []
        for a, b, r in found:
            if not any(x <= a and b <= y for x, y, _ in kept):
                kept.append((a, b, r))
        assert sorted(kept, key=lambda d: (d[0], d[1], d[2].label)) == scanner.detections(line)


def test_license_odd_rows(spark, odd_docs, no_docs):
    rows = lic.scan_licenses(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.n_words == len(words(r.text)) and r.labels == "" and r.score == 0 for r in rows)
    assert lic.scan_licenses(no_docs).count() == 0


# op 6

LIB = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def n_ids(text):
    return len(LIB.encode(text or "", add_special_tokens=False).ids)


def test_edit_trees_equal_whole_encoding(monkeypatch):
    monkeypatch.setattr(edits, "LEAF", 16)
    rng, count = random.Random(3), edits._counter(None)
    alphabet = list("abcd  '  \n\t.,1é<|s") + ["'s", "'re", "  ", "<|endoftext|>", " the", " and"]
    for _ in range(250):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 200)))
        leaves = edits.leaves_of(text, 16)
        tree = edits.CountTree(leaves, [count(x) for x in leaves], count)
        for _ in range(6):
            start, n, new = rng.randint(0, len(text) + 2), rng.randint(0, 30), "".join(rng.choices(alphabet, k=rng.randint(0, 40)))
            at = min(start, len(text))
            text = text[:at] + new + text[min(at + n, len(text)):]
            tree.edit(start, n, new)
            assert tree.text() == text and tree.n_tokens == n_ids(text) and tree.n_chars == len(text)


def test_edit_touches_little(long_text):
    tree = edits.CountTree.of(long_text, edits._counter(None))
    tree.edit(len(long_text) // 2, 10, "something new")
    assert tree.encoded_chars < 6 * edits.LEAF


def test_edit_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").withColumn("edits", edits.derived_edits()).collect()
    rows = {r.doc_id: r for r in E.queries()["op6_edit_counts"](spark, SF).collect()}
    for d in docs:
        text = d.text
        for e in d.edits:
            at = min(e.start, len(text))
            text = text[:at] + e.insertion + text[min(at + e.n_delete, len(text)):]
        r = rows[d.doc_id]
        assert (r.n_tokens, r.n_tokens_after, r.n_chars_after) == (n_ids(d.text), n_ids(text), len(text))


def test_edit_odd_rows(spark, odd_docs, no_docs):
    from pyspark.sql import functions as F
    log = ("array(named_struct('start', null, 'n_delete', null, 'insertion', 'new '), "
           "named_struct('start', 10000000000L, 'n_delete', -5L, 'insertion', null), "
           "named_struct('start', -3L, 'n_delete', 2L, 'insertion', ''))")
    docs = odd_docs.withColumn("edits", F.expr(log)).unionByName(odd_docs.withColumn("edits", F.expr(f"filter({log}, x -> false)")))
    for r in edits.apply_edits(edits.build_trees(docs)).collect():
        assert r.n_tokens_after == n_ids(r.text) and sum(r.leaf_tokens) == r.n_tokens_after
    assert edits.apply_edits(edits.build_trees(no_docs.withColumn("edits", F.expr(log)))).count() == 0


# op 7

def brute_hits(doc, items, window):
    w, hit, found = words(doc), set(), set()
    for item, text in items:
        v = words(text)
        n = min(window, len(v))
        for i in range(len(v) - n + 1 if n else 0):
            for j in range(len(w) - n + 1):
                if w[j:j + n] == v[i:i + n]:
                    hit.update(range(j, j + n))
                    found.add(item)
    return len(w), hit, found


def test_decontam_against_brute_force(spark):
    rng = random.Random(6)
    vocabulary = ["a", "b", "c", "Ä", "é1", "B"]
    items = [(i, " ".join(rng.choices(vocabulary, k=k))) for i, k in enumerate([0, 1, 2, 3, 4, 6, 9, 3, 5])] + [(3, "zz"), (None, "c c c"), (99, None)]
    docs = [(i, rng.choice(["", ", "]).join([" ".join(rng.choices(vocabulary, k=rng.randint(0, 30)))])) for i in range(60)]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for max_nodes in (1 << 20, 240):            # one automaton; several passes
        rows = deco.scan_documents(df, bench, window=4, max_nodes=max_nodes).select("*", deco.hit_words().alias("n_hit")).collect()
        for r in rows:
            n, hit, found = brute_hits(r.text, items, 4)
            assert (r.n_words, r.n_hit) == (n, len(hit))
            assert r["items"] == sorted(str(x) for x in found if x is not None)


def test_decontam_spans(spark):
    text = "Well, A -- b! (C) d; and more"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    row = deco.with_spans(deco.scan_documents(df, bench)).first()
    assert [text[s.start:s.end] for s in row.spans] == ["A -- b! (C) d"]


def test_decontam_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(7, "The QUICK brown fox jumps over the lazy dog again and more")], "item_id long, text string")
    rows = deco.scan_documents(odd_docs, bench).collect()
    assert len(rows) == odd_docs.count()
    assert sorted(str(r.doc_id) for r in rows if r.hits) == ["1", "1", "2"]
    assert all(r.n_words == len(words(r.text)) for r in rows)
    none = bench.limit(0)
    assert deco.clean_documents(odd_docs, none).count() == odd_docs.count()
    assert deco.clean_documents(odd_docs, bench).columns == odd_docs.columns
    assert deco.scan_documents(no_docs, bench).count() == 0


def test_decontam_digest(spark):
    r = E.queries()["op7_decontam"](spark, SF).filter("not contaminated").first()
    assert r.items_sha256 == hashlib.sha256(b"").hexdigest() and r.n_items == 0


# op 10

def test_toxicity_query(spark):
    rows = E.queries()["op10_toxicity"](spark, SF01).collect()
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= .5) for r in rows)


def test_toxicity_on_held_out_rows(spark):
    """Held-out labels: part of the toxic ones stand on texts without a toxic word, so not all can be found; "never toxic" finds none."""
    sf = SF01.replace("sf0.01", "sf0.1")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    size = {r.doc_id: len((r.text or "").split()) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    known = [r for r in E.queries()["op10_toxicity"](spark, sf).collect() if r.held_out and labels.get(r.doc_id) is not None]
    share = lambda rows: sum(r.predicted for r in rows) / len(rows)
    assert share([r for r in known if labels[r.doc_id]]) > .65
    assert share([r for r in known if not labels[r.doc_id] and size[r.doc_id] <= 300]) < .01
    assert share([r for r in known if not labels[r.doc_id] and size[r.doc_id] > 300]) < .04


@pytest.mark.parametrize("at", [0.0, 0.37, 0.999])
def test_toxicity_sees_every_place_of_a_long_text(at):
    """The only toxic word of a long training text may stand anywhere."""
    rng = random.Random(9)
    syllables = ["ba", "ne", "to", "li", "su", "ra", "mi", "ko", "pe", "du"]
    plain = lambda: "".join(rng.choices(syllables, k=rng.randint(2, 3)))

    def text(n, bad):
        words = [plain() for _ in range(n)]
        if bad:
            words.insert(int(at * n), "scumbag")
        return " ".join(words)
    y = [k % 2 for k in range(160)]
    model = tox.train([text(2000, k) for k in y], y)
    score = lambda t: model.score(model.text_logit(model.word_logits([tox.letters_of(w) for w in tox.tokens_of(t)])))
    assert sum(score(text(2000, 1)) >= .5 for _ in range(20)) >= 18
    assert sum(score(text(2000, 0)) >= .5 for _ in range(20)) <= 2


def test_toxicity_reads_long_tokens_whole():
    assert tox.tokens_of("a " + "x" * 250_000 + " b") == ["a", "x" * 100_000, "x" * 100_000, "x" * 50_000, "b"]
    assert tox.tokens_of(None) == [] and tox.tokens_of(" a  b ") == ["a", "b"]


def test_toxicity_sample_bound(spark):
    docs = spark.createDataFrame([(i, "w " * 500) for i in range(60)] + [(99, "x" * (tox.MAX_TEXT + 1))], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    picked = tox.training_rows(docs, labels, max_rows=20, max_bytes=8000).collect()
    assert all(r.text == "w " * 500 for r in picked)
    assert max(sum(r.toxic == c for r in picked) for c in (0, 1)) == 8


def test_toxicity_learns_misspellings():
    rng = random.Random(8)
    syllables = ["ba", "ne", "to", "li", "su", "ra", "mi", "ko", "pe", "du"]
    plain = lambda: "".join(rng.choices(syllables, k=rng.randint(2, 4)))
    text = lambda bad: " ".join([plain() for _ in range(rng.randint(5, 150))] + (["scumbag"] if bad else []))
    y = [k % 2 for k in range(240)]
    model = tox.train([text(k) for k in y], y)
    score = lambda t: model.score(model.text_logit(model.word_logits([tox.letters_of(w) for w in t.split()])))
    assert sum(score(text(1)) >= .5 for _ in range(60)) >= 55
    assert sum(score(text(0)) >= .5 for _ in range(60)) <= 5
    assert sum(score(text(0) + " scumbags scummbag") >= .5 for _ in range(40)) >= 34


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, "x"), (1, 0, "x"), (2, 0, "x"), (3, None, "x"), (None, 1, "x"), (7, 0, "x"), (77, 1, "x")],
                                   "doc_id long, toxic int, text string")
    model = tox.fit(odd_docs, labels)
    rows = tox.score_documents(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    assert tox.score_documents(no_docs, model).count() == 0
    assert tox.keep_clean(odd_docs, labels.limit(0)).count() == odd_docs.count()
