"""Language ID with interpolated Kneser-Ney character models in sorted hash arrays.

Words (runs of letters, lower-cased) are read between a start and an end mark;
a character is predicted from up to ``ORDER`` - 1 characters before it in its
word. Per language, n-gram counts of a bounded training sample (about
``MAX_DOCS`` documents by a hash of the id) are summed in Spark. The highest
order uses counts, lower orders the number of distinct characters seen before
an n-gram (n-grams at a word's start have none before them and use counts).
Each order subtracts its discount n1 / (n1 + 2 n2) and hands the mass on to the
next lower order. A language is smoothed on all n-grams of its sample, one
language at a time; then it keeps those of orders 1 and 2 and the most frequent
others, an equal number for each language (``MAX_ENTRIES`` in all), and its
back-off weights are set anew so that probabilities still sum to one. The
n-grams of all languages share one sorted array of 64-bit hashes; each has the
entries (language, log probability, back-off weight) of the languages that know
it.

A text goes to the language with the lowest cross-entropy in bits a character
over all its words. The margin to the runner-up, scaled by the text's length,
gives the score by a logistic fit on held-back sample rows; ``accepted`` is
false below the score that keeps the error of accepted rows within
``TARGET_ERROR`` there.

Defined cases: a text that is null or holds no letter is ``und`` with score 0
and not accepted; rows without a language are not learned from; equal
cross-entropies go to the first language in code-point order; with one learned
language every text with letters gets it; with none, ``und``; repeated rows are
judged each by itself; columns named like the added ones are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecraft.llm.common import ship, table, text_parts
from ratecraft.llm.op08_mix import unit_hash
from ratecraft.llm.op10_toxicity import platt, sigmoid
from ratecraft.llm.wordgrams import LEFT, code_points, rolling, slices
from ratecraft.session import materialize

ORDER = 4
MAX_DOCS = 2500              # training documents of a language (about, by hash)
TOTAL_DOCS = 50_000          # of all languages together
MAX_ENTRIES = 8_000_000      # (language, n-gram) entries of the model, the same share for each language
MOST_ENTRIES = 250_000       # of one language
CALIBRATE = 0.2              # share of the sample that fits score and rejection
TARGET_ERROR = 0.01
CACHE_TOKENS = 250_000
LONG_WORD = 50_000
FOLDS, HELD_OUT = 3, 1
_RUN = re.compile(r"[^\W\d_]+")


def words_of(token: str) -> list[str]:
    """Letter runs of a white-space token, lower-cased; a run longer than ``LONG_WORD`` in pieces."""
    t = token.lower()
    out = [t] if t.isalpha() else [x for r in _RUN.findall(t) if (x := "".join(c for c in r if c.isalpha()))]
    return out if len(t) <= LONG_WORD else [w[i:i + LONG_WORD] for w in out for i in range(0, len(w), LONG_WORD)]


@dataclass
class Model:
    """langs; sorted n-gram hashes; per n-gram the entries first[i]..first[i + 1] (language, log2 probability or NaN,
    log2 back-off); probability of an unknown character per language; score fit."""
    langs: list[str]
    grams: np.ndarray
    first: np.ndarray
    lang: np.ndarray
    logp: np.ndarray
    backoff: np.ndarray
    unknown: np.ndarray
    slope: float = 1.0
    offset: float = 0.0
    accept: float = 0.0

    def word_bits(self, words: list[str]) -> np.ndarray:
        """log2 probability of each word under each language."""
        out = np.zeros((len(words), len(self.langs)))
        for lo, hi in slices([len(w) for w in words], 100_000):
            out[lo:hi] = self._bits(words[lo:hi])
        return out

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``rows``, entry) of all entries of the n-grams ``rows``."""
        start, n = self.first[rows], self.first[rows + 1] - self.first[rows]
        of = np.repeat(np.arange(len(rows)), n)
        return of, np.arange(len(of)) + np.repeat(start - (np.cumsum(n) - n), n)

    def _bits(self, words: list[str]) -> np.ndarray:
        cps, starts = code_points(words)
        width = len(self.langs)
        value = np.tile(self.unknown, len(cps))  # position by position, a number for each language
        before = None                            # n-gram row that ends at each position, one order lower
        for n in range(1, ORDER + 1):
            h, end = rolling(cps, starts, n)
            row = np.full(len(cps), -1, np.int64)
            if len(self.grams):
                at = np.minimum(np.searchsorted(self.grams, h), len(self.grams) - 1)
                row[end] = np.where(self.grams[at] == h, at, -1)
            if n > 1:
                known = end[before[end - 1] >= 0]
                of, entry = self._entries(before[known - 1])
                value[(known * width)[of] + self.lang[entry]] += self.backoff[entry]
            seen = np.flatnonzero(row >= 0)
            of, entry = self._entries(row[seen])
            p, at = self.logp[entry], (seen * width)[of] + self.lang[entry]
            if n == 1:                           # the start mark has no probability of its own
                p, at = p[~np.isnan(p)], at[~np.isnan(p)]
            value[at] = p
            before = row
        value = value.reshape(len(cps), width)
        value[starts[:-1]] = 0                   # the start mark is given, not predicted
        return np.add.reduceat(value, starts[:-1], axis=0)


def _place(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each key in a sorted table, -1 if it is not there."""
    at = np.minimum(np.searchsorted(table, keys), max(len(table) - 1, 0))
    return np.where(table[at] == keys, at, -1) if len(table) else np.full(len(keys), -1)


def kneser_ney(order: np.ndarray, gram: np.ndarray, context: np.ndarray, suffix: np.ndarray, initial: np.ndarray, count: np.ndarray,
               keep: int = MOST_ENTRIES) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """One language from its n-grams (order, hashes of the n-gram, its context and its suffix, whether it starts a
    word, count): sorted hashes, log2 probabilities (NaN for the start mark), log2 back-off weights, log2
    probability of an unknown character. At most ``keep`` n-grams above order 2 stay."""
    by = np.argsort(gram)
    order, gram, context, suffix, initial, count = (x[by] for x in (order, gram, context, suffix, initial, count))
    size = len(gram)
    prob, spread = np.full(size, np.nan), 1.0
    below, above = _place(gram, suffix), _place(gram, context)
    alphabet = max(256, 2 * int(np.sum(order == 1)))
    for n in range(1, ORDER + 1):
        own = np.flatnonzero((order == n) & ~((n == 1) & initial))          # the start mark is only a context
        if not len(own):
            continue
        c = count[own].astype(np.float64)
        if n < ORDER:                        # distinct left extensions, from the next order
            up = below[(order == n + 1) & (below >= 0)]
            c = np.where(initial[own], c, np.maximum(np.bincount(up, minlength=size)[own], 1))
        n1, n2 = np.sum(c == 1), np.sum(c == 2)
        d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        if n == 1:
            spread = d * len(c) / c.sum() / alphabet
            prob[own] = np.maximum(c - d, 0) / c.sum() + spread
            continue
        _, inverse = np.unique(context[own], return_inverse=True)
        total = np.bincount(inverse, weights=c)
        gamma = d * np.bincount(inverse) / total
        base = np.where(below[own] >= 0, prob[below[own]], np.nan)
        prob[own] = np.maximum(c - d, 0) / total[inverse] + gamma[inverse] * np.where(np.isnan(base), spread, base)
    # prune: by count, lower orders first among equals, so what stays holds the contexts and suffixes of all that stays
    rank = np.lexsort((gram, order, -count, order > 2))
    stays = np.zeros(size, bool)
    stays[rank[:int(np.sum(order <= 2)) + keep]] = True
    backoff = np.ones(size)
    for n in range(2, ORDER + 1):
        own = np.flatnonzero((order == n) & stays & (above >= 0))
        if not len(own):
            continue
        # the suffix of what stays stays, and holds its lower probability (or it is an unknown character)
        low = np.where(below[own] >= 0, prob[below[own]], np.nan)
        low = np.where(np.isnan(low), spread, low)
        held, lower = (np.bincount(above[own], weights=x, minlength=size) for x in (prob[own], low))
        at = np.unique(above[own])
        backoff[at] = np.maximum(1 - held[at], 1e-9) / np.maximum(1 - lower[at], 1e-9)
    with np.errstate(divide="ignore"):
        return gram[stays], np.log2(prob[stays]).astype(np.float32), np.log2(backoff[stays]).astype(np.float32), float(np.log2(spread))


def join_languages(langs: list[str], parts: list[tuple]) -> Model:
    """One model from the languages' tables (``kneser_ney``)."""
    if not langs:
        return Model([], np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.int16), np.zeros(0), np.zeros(0), np.zeros(0))
    gram = np.concatenate([p[0] for p in parts])
    lang = np.repeat(np.arange(len(langs), dtype=np.int16), [len(p[0]) for p in parts])
    by = np.lexsort((lang, gram))
    gram = gram[by]
    new = np.flatnonzero(np.append(True, gram[1:] != gram[:-1])) if len(gram) else np.zeros(0, np.int64)
    pick = lambda k: np.concatenate([p[k] for p in parts])[by]
    return Model(langs, gram[new], np.append(new, len(gram)).astype(np.int64), lang[by], pick(1), pick(2), np.array([p[3] for p in parts]))


def _count_words(batches):
    counts: Counter = Counter()

    def flush():
        keys = list(counts)
        out = pa.record_batch([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                               pa.array([counts[k] for k in keys], pa.int64())], names=["lang", "word", "n"])
        counts.clear()
        return out

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            for token, n in Counter((text or "").split()).items():
                for w in words_of(token):
                    counts[lang, w] += n
            if len(counts) > 300_000:
                yield flush()
    if counts:
        yield flush()


def _count_grams(batches):
    names = ["lang", "n", "gram", "context", "suffix", "initial", "count"]
    for batch in batches:
        langs, words, counts = (batch.column(c).to_pylist() for c in ("lang", "word", "n"))
        for lo, hi in slices([len(w) for w in words], 300_000):
            cps, starts = code_points(words[lo:hi])
            of_word = np.repeat(np.arange(hi - lo), np.diff(starts))
            count = np.array(counts[lo:hi], np.int64)
            code, kinds = np.unique(np.array(langs[lo:hi], object).astype(str), return_inverse=True)
            lower = None
            for n in range(1, ORDER + 1):
                h, end = rolling(cps, starts, n)
                at = np.zeros(len(cps), np.uint64)
                at[end] = h
                first = cps[end - n + 1] == LEFT
                w = of_word[end]
                part = {"kind": kinds[w], "gram": h, "context": at[end] if n == 1 else lower[end - 1],
                        "suffix": at[end] if n == 1 else lower[end], "initial": first, "count": count[w]}
                lower = at
                # one row for each (language, n-gram) of this slice
                order = np.lexsort((part["gram"], part["kind"]))
                part = {k: v[order] for k, v in part.items()}
                if not len(order):
                    continue
                new = np.concatenate([[True], (part["gram"][1:] != part["gram"][:-1]) | (part["kind"][1:] != part["kind"][:-1])])
                at_new = np.flatnonzero(new)
                total = np.add.reduceat(part["count"], at_new)
                one = {k: v[at_new] for k, v in part.items()}
                yield pa.record_batch(
                    [pa.array(code[one["kind"]].tolist(), pa.string()), pa.array(np.full(len(at_new), n, np.int32)),
                     *[pa.array(one[k].view(np.int64)) for k in ("gram", "context", "suffix")],
                     pa.array(one["initial"]), pa.array(total)], names=names)


def held_out(doc_id: F.Column) -> F.Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(FOLDS)) == HELD_OUT


def training_sample(docs: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """lang, text, part in [0, 1) of about ``max_docs`` documents of each language outside the held-out fold."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    per = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = per.withColumn("share", F.least(F.lit(float(max_docs)), F.lit(float(TOTAL_DOCS)) / F.count(F.lit(1)).over(_all())) / F.col("n"))
    share = materialize(share.select("lang", "share"), "lang-share")
    return (known.select("doc_id", "lang", "text").join(share, "lang")
            .filter(unit_hash(F.col("doc_id"), "lang-sample") < F.col("share"))
            .select("lang", "text", unit_hash(F.col("doc_id"), "lang-part").alias("part")))


def _all():
    from pyspark.sql import Window
    return Window.partitionBy()


def fit(docs: DataFrame, max_docs: int = MAX_DOCS) -> Model:
    """Train on the sample: counts in Spark, smoothing in numpy over the bounded n-gram table."""
    ship(docs.sparkSession)
    sample = materialize(training_sample(docs, max_docs), "lang-sample")
    langs = sorted(r.lang for r in sample.select("lang").distinct().collect())
    if not langs:
        return join_languages([], [])
    words = (sample.filter(F.col("part") >= CALIBRATE).select("lang", "text")
             .mapInArrow(_count_words, "lang string, word string, n long")
             .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    grams = (words.mapInArrow(_count_grams, "lang string, n int, gram long, context long, suffix long, initial boolean, count long")
             .groupBy("lang", "n", "gram").agg(F.first("context").alias("context"), F.first("suffix").alias("suffix"),
                                               F.first("initial").alias("initial"), F.sum("count").alias("count")))
    grams = materialize(grams, "lang-grams")
    keep, parts = min(MOST_ENTRIES, MAX_ENTRIES // len(langs)), []
    for lang in langs:                       # one bounded sample at a time
        t = grams.filter(F.col("lang") == lang).drop("lang").toArrow()
        col = lambda c: t.column(c).to_numpy()  # noqa: E731,B023
        parts.append(kneser_ney(col("n"), *(col(c).view(np.uint64) for c in ("gram", "context", "suffix")), col("initial"), col("count"), keep))
    model = join_languages(langs, parts)
    seen = predict(sample.filter(F.col("part") < CALIBRATE).select("lang", "text"), model).select(
        (F.col("lang") == F.col("lang_pred")).alias("right"), "evidence").filter("evidence is not null").toArrow()
    return calibrate(model, seen.column("evidence").to_numpy(), seen.column("right").to_numpy(zero_copy_only=False))


def calibrate(model: Model, evidence: np.ndarray, right: np.ndarray) -> Model:
    """Fit the score, and the lowest score whose accepted rows err within ``TARGET_ERROR``."""
    if len(right):
        y = right.astype(np.float64)
        model.slope, model.offset = platt(evidence, y, np.ones(len(y)))
        model.slope = max(model.slope, 1e-6)
        order = np.argsort(-evidence)
        errors = np.cumsum(1 - y[order]) / np.arange(1, len(y) + 1)
        good = np.flatnonzero(errors <= TARGET_ERROR)
        last = evidence[order[good[-1]]] if len(good) else np.inf
        model.accept = float(sigmoid(np.minimum(model.slope * last + model.offset, 40)))
    return model


_NEW = {"lang_pred": pa.string(), "score": pa.float64(), "accepted": pa.bool_(), "bits": pa.float64(), "evidence": pa.float64()}


def _predict_batches(shared):
    state: dict = {}

    def run(batches):
        model: Model = shared.value
        width = len(model.langs) + 1
        cache: dict[str, int] = state.setdefault("cache", {})
        rows = state.get("rows")
        if rows is None:
            rows = state["rows"] = np.zeros((1 << 14, width), np.float32)
        for batch in batches:
            out = {c: [] for c in _NEW}
            for part in text_parts(batch, max_bytes=1 << 20):
                texts = [(t or "").split() for t in part.column("text").to_pylist()]
                new = {w for tokens in texts for w in tokens if w not in cache}
                if len(cache) + len(new) > CACHE_TOKENS:
                    cache.clear()
                    new = {w for tokens in texts for w in tokens}
                if new:
                    new = list(new)
                    split = [words_of(t) for t in new]
                    flat = [w for ws in split for w in ws]
                    bits = model.word_bits(flat) if flat and model.langs else np.zeros((len(flat), width - 1))
                    size = np.array([len(w) + 1 for w in flat], np.float64)
                    owner = np.repeat(np.arange(len(new)), [len(ws) for ws in split])
                    value = np.zeros((len(new), width))
                    np.add.at(value, owner, np.column_stack([bits, size]) if len(flat) else value[:0])
                    at = len(cache)
                    while at + len(new) > len(rows):
                        rows = state["rows"] = np.concatenate([rows, np.zeros_like(rows)])
                    rows[at:at + len(new)] = value
                    cache.update(zip(new, range(at, at + len(new))))
                for tokens in texts:
                    total = rows[np.fromiter(map(cache.__getitem__, tokens), np.int64, len(tokens))].sum(0, dtype=np.float64)
                    for c, v in zip(_NEW, judge(model, total)):
                        out[c].append(v)
            yield pa.record_batch([*batch.columns, *[pa.array(out[c], k) for c, k in _NEW.items()]],
                                  names=[*batch.schema.names, *_NEW])
    return run


def judge(model: Model, total: np.ndarray):
    """(language, score, accepted, bits a character, evidence) from summed log2 probabilities and characters."""
    chars = total[-1]
    if chars == 0 or not model.langs:
        return "und", 0.0, False, None, None
    entropy = -total[:-1] / chars
    best = int(np.argmin(entropy))
    margin = float(np.min(np.delete(entropy, best)) - entropy[best]) if len(entropy) > 1 else 1.0
    evidence = margin * float(np.sqrt(min(chars, 400.0)))
    score = float(sigmoid(model.slope * evidence + model.offset))
    return model.langs[best], score, score >= model.accept, float(entropy[best]), evidence


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (any columns, ``text`` among them) with lang_pred, score, accepted, bits, evidence."""
    ship(docs.sparkSession)
    docs = docs.drop(*_NEW)
    kinds = {"lang_pred": T.StringType(), "accepted": T.BooleanType()}
    schema = T.StructType([*docs.schema.fields, *[T.StructField(c, kinds.get(c, T.DoubleType())) for c in _NEW]])
    return docs.mapInArrow(_predict_batches(docs.sparkSession.sparkContext.broadcast(model)), schema)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.select("doc_id", "text", "lang"))
    return (predict(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted", "bits"))
