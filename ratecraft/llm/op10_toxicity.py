"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (``ORDERS``, with word-boundary
marks) hashed into ``BUCKETS`` embedding rows, so an unseen misspelling shares
vectors with words it resembles. A passage (``WINDOW`` consecutive words, the
next one starting half a window later) is the mean of its words' vectors, and
a linear layer with softmax gives its class. A text's logit is that of its
worst passage, so a few words decide in a text of any length (the mean over a
whole text of thousands of words would hide them).

Training (numpy, on the driver) uses a bounded sample of labelled rows, whole
texts: at most ``MAX_ROWS`` of each label by a hash of the id, as far as they
fit into ``MAX_BYTES`` together (a labelled text above ``MAX_TEXT`` bytes is not
sampled). Embeddings and the linear layer are trained jointly by Adam on the
cross-entropy of all passages. The labels mark whole texts, so it alternates:
first every passage carries its text's label, then a toxic text is held by the
passages that the current model finds worst, while all passages of clean texts
stay clean. A logistic fit of the text logit (Platt) over a part of the sample
that no step has trained on gives the score.

Because the last layer is linear, a word's vector matters to the score only by
two numbers; workers keep them per word in a bounded cache. The model that is
broadcast has a fixed size (``BUCKETS`` floats).

Defined cases: a null or empty text (or one without letters) scores as a
passage of no words, that is the fitted prior of an empty passage; null labels
and labelled ids without a document are not used; repeated rows are scored each
by itself; without any labelled row of both classes every score is the share of
toxic labels (0 if there are no labels); columns named like the added ones are
replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecraft.llm.common import aside, ship, table, text_parts
from ratecraft.llm.wordgrams import code_points, rolling, slices

ORDERS = (3, 4, 5)
BUCKETS = 1 << 17
DIM = 4
WINDOW = 2
MAX_ROWS = 1200             # labelled rows of each class that training may use
MAX_BYTES = 12 << 20        # of their texts, for each class
MAX_TEXT = 2 << 20          # of one of them
EPOCHS = (30, 30, 30)       # Adam steps before each re-attribution of the toxic texts' labels
DECAY = 0.02
HARD = 4.0                  # extra weight of a clean passage that the model gets wrong
HARD_WORD = 20.0            # extra weight of a clean word that is not clearly clean
ALONE = 0.5                 # weight of the clean words as passages of their own
CALIBRATE = 0.2             # share of the training rows that fits the score
CACHE_WORDS = 250_000
LONG_WORD = 100_000         # characters of a token that are one word; a longer token is read as several
HOLD_OUT = 5
_CLEAN = re.compile(r"[\W\d_]+")


def letters_of(token: str) -> str:
    """A white-space token as the model sees it: lower case, letters only."""
    return token.lower() if token.isalpha() else _CLEAN.sub("", token.lower())


def tokens_of(text: str | None) -> list[str]:
    """White-space tokens of a whole text; one longer than ``LONG_WORD`` in pieces of that length."""
    tokens = (text or "").split()
    if text and len(text) > LONG_WORD and max(map(len, tokens), default=0) > LONG_WORD:
        return [t[i:i + LONG_WORD] for t in tokens for i in range(0, len(t), LONG_WORD)]
    return tokens


def word_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every n-gram, start of each word's n-grams (n + 1)); a word without letters has none."""
    parts, counts = [], []
    for lo, hi in slices([len(w) for w in words]):
        cps, starts = code_points(words[lo:hi])
        word_at = np.repeat(np.arange(hi - lo, dtype=np.int32), np.diff(starts))
        gram, owner = [], []
        for n in ORDERS:
            h, end = rolling(cps, starts, n)
            gram.append((h & np.uint64(BUCKETS - 1)).astype(np.int32))
            owner.append(word_at[end])
        gram, owner = np.concatenate(gram), np.concatenate(owner)
        parts.append(gram[np.argsort(owner, kind="stable")])
        counts.append(np.bincount(owner, minlength=hi - lo))
    if not parts:
        return np.zeros(0, np.int32), np.zeros(1, np.int64)
    return np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(counts))])


def running(values: np.ndarray) -> np.ndarray:
    """0 and the running sums of ``values``."""
    out = np.zeros(len(values) + 1)
    np.cumsum(values, out=out[1:])
    return out


def segment_mean(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Mean of each run values[starts[i]:starts[i + 1]] (0 for an empty run)."""
    total = running(values)
    n = np.diff(starts)
    return (total[starts[1:]] - total[starts[:-1]]) / np.maximum(n, 1)


def passages(n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the passages of a text of ``n_words`` words (one at least)."""
    window, step = WINDOW, max(1, WINDOW // 2)
    start = np.arange(0, max(1, n_words - window + step), step)
    return start, np.minimum(start + window, n_words)


@dataclass
class Model:
    """Per-bucket logit difference, bias, and the fitted score slope and offset."""
    weight: np.ndarray
    bias: float
    slope: float
    offset: float

    def word_logits(self, words: list[str]) -> np.ndarray:
        """Mean n-gram weight of each word; worked off in slices so that memory stays bounded."""
        out = np.zeros(len(words))
        for lo, hi in slices([len(w) for w in words]):
            gram, starts = word_buckets(words[lo:hi])
            out[lo:hi] = segment_mean(self.weight[gram], starts)
        return out

    def text_logit(self, word_logits: np.ndarray) -> float:
        total = np.concatenate([[0.0], np.cumsum(word_logits)])
        a, b = passages(len(word_logits))
        return float(np.max((total[b] - total[a]) / np.maximum(b - a, 1))) + self.bias

    def score(self, logit: float) -> float:
        return float(sigmoid(self.slope * logit + self.offset))


def train(texts: list[str | None], toxic: list[int], share: float | None = None, epochs: tuple[int, ...] = EPOCHS,
          rate: float = 0.05, seed: int = 7) -> Model:
    """Fit the model on labelled texts; ``share`` is the share of toxic texts to calibrate for."""
    y_doc = np.asarray(toxic, np.int64)
    if len(set(toxic)) < 2:
        share = float(np.mean(y_doc)) if len(y_doc) else 0.0
        return Model(np.zeros(BUCKETS, np.float32), 0.0, 0.0, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    share = float(np.mean(y_doc)) if share is None else share
    vocabulary: dict[str, int] = {}
    words, first, last, n_passages = [], [], [], np.zeros(len(y_doc), np.int64)
    rng = np.random.default_rng(seed)
    kept = rng.random(len(y_doc)) >= CALIBRATE          # the rest calibrates the score
    clean_type, at = [], 0
    for d, text in enumerate(texts):
        w = np.array([vocabulary.setdefault(letters_of(t), len(vocabulary)) for t in tokens_of(text)], np.int32)
        if kept[d] and not y_doc[d]:
            clean_type.append(np.unique(w))
        a, b = passages(len(w))
        words.append(w)
        first.append((a + at).astype(np.int32))
        last.append((b + at).astype(np.int32))
        n_passages[d] = len(a)
        at += len(w)
    word, first, last = (np.concatenate(x) for x in (words, first, last))
    del words
    n_in = np.maximum(last - first, 1).astype(np.int32)
    doc_of = np.repeat(np.arange(len(y_doc), dtype=np.int32), n_passages)
    of_doc = np.concatenate([[0], np.cumsum(n_passages)[:-1]])          # a document's first passage
    types = list(vocabulary) or [""]
    gram, g_start = word_buckets(types)
    g_n = np.maximum(np.diff(g_start), 1)
    type_of_gram = np.repeat(np.arange(len(types), dtype=np.int32), np.diff(g_start))

    emb = rng.normal(0, 1 / DIM, (BUCKETS, DIM))
    layer = rng.normal(0, 1 / np.sqrt(DIM), (DIM, 2))
    bias = np.zeros(2)
    moments = {k: [np.zeros_like(x), np.zeros_like(x)] for k, x in (("emb", emb), ("layer", layer), ("bias", bias))}
    step = 0

    def weights():
        """The embeddings seen through the layer: each bucket's difference of the two class logits."""
        return np.einsum("bd,d->b", emb, layer[:, 1] - layer[:, 0])

    def forward():
        """Logit of every word type alone, and of every passage."""
        by_type = segment_mean(weights()[gram], g_start)
        upto = running(by_type[word])
        return by_type + (bias[1] - bias[0]), (upto[last] - upto[first]) / n_in + (bias[1] - bias[0])

    def adam(name, x, grad, decay=0.0):
        m, v = moments[name]
        m += 0.1 * (grad - m)
        v += 0.001 * (grad * grad - v)
        x *= 1 - rate * decay
        x -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)

    y = y_doc[doc_of].astype(np.float64)
    # each word of the whole clean texts is also a clean passage of its own, so that no word can look toxic alone
    clean = np.zeros(len(types))
    if clean_type:
        clean[np.concatenate(clean_type)] = 1.0
    alone = clean * (ALONE / max(clean.sum(), 1))
    use = kept[doc_of].astype(np.float64)
    for phase, n_steps in enumerate(epochs):
        if phase:                            # toxic texts hold only by their worst passages from here on
            single, margin = forward()
            alone = clean * (1.0 + HARD_WORD * (single > -1))
            alone *= ALONE / max(alone.sum(), 1)
            best = np.maximum.reduceat(margin, of_doc)
            worst = (margin >= best[doc_of] - 1e-12) | (margin > np.maximum(0.5 * best[doc_of], 0))
            use = kept[doc_of] * np.where(y == 1, worst, 1.0 + HARD * (margin > 0))
        balance = np.where(y == 1, 0.5 / max(use[y == 1].sum(), 1), 0.5 / max(use[y == 0].sum(), 1)) * use
        for _ in range(n_steps):
            step += 1
            single, margin = forward()
            g = balance * (sigmoid(margin) - y)         # d loss / d z1 = - d loss / d z0
            g_alone = alone * sigmoid(single)
            share_of = g / n_in                         # a passage's part for each of its words
            of_word = np.cumsum(np.bincount(first, share_of, len(word) + 1) - np.bincount(last, share_of, len(word) + 1))[:-1]
            by_word = np.bincount(word, weights=of_word, minlength=len(types)) + g_alone
            by_bucket = np.bincount(gram, weights=(by_word / g_n)[type_of_gram], minlength=BUCKETS)
            d_layer = np.einsum("bd,b->d", emb, by_bucket)
            adam("emb", emb, by_bucket[:, None] * (layer[:, 1] - layer[:, 0]), DECAY)
            adam("layer", layer, np.stack([-d_layer, d_layer], 1))
            adam("bias", bias, np.array([-1.0, 1.0]) * (g.sum() + g_alone.sum()))
    weight = weights()
    seen = np.zeros(BUCKETS, bool)
    seen[gram] = True
    weight[~seen] = 0.0                      # n-grams never trained on speak for no class
    _, margin = forward()
    text_logit = np.maximum.reduceat(margin, of_doc)
    held = ~kept if len(set(y_doc[~kept])) == 2 else np.ones(len(y_doc), bool)
    prior = np.where(y_doc == 1, share / max(np.mean(y_doc[held]), 1e-9), (1 - share) / max(1 - np.mean(y_doc[held]), 1e-9))
    slope, offset = platt(text_logit[held], y_doc[held], prior[held])
    return Model(weight.astype(np.float32), float(bias[1] - bias[0]), slope, offset)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(np.clip(-x, -40, 40)))


def platt(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 50, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and offset of a weighted, ridge-penalised logistic fit by Newton steps."""
    mean, scale = x.mean(), x.std() + 1e-9
    a = np.stack([(x - mean) / scale, np.ones(len(x))], 1)
    w = np.zeros(2)
    for _ in range(steps):
        p = sigmoid(a @ w)
        h = np.einsum("ni,nj,n->ij", a, a, weight * p * (1 - p)) + ridge * np.eye(2)
        w -= np.linalg.solve(h, np.einsum("ni,n->i", a, weight * (p - y)) + ridge * w)
    return float(w[0] / scale), float(w[1] - w[0] * mean / scale)


def fold(doc_id: F.Column) -> F.Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(HOLD_OUT))


def known_labels(labels: DataFrame) -> DataFrame:
    """One row (_id, toxic) per labelled id outside the held-out fold; toxic if any of its rows says so."""
    return (labels.select(F.col("doc_id").alias("_id"), "toxic").filter("toxic is not null and _id is not null")
            .filter(fold(F.col("_id")) != 0).groupBy("_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Text and label of at most ``max_rows`` labelled documents of each class outside the held-out fold, ``max_bytes`` together."""
    known = known_labels(labels)
    key = F.xxhash64("_id", F.lit(11))
    picked = [known.filter(F.col("toxic") == c).orderBy(key, "_id").limit(max_rows) for c in (0, 1)]
    sample = picked[0].unionByName(picked[1])
    texts = (docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
             .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")))
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    upto = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    return texts.filter(size <= MAX_TEXT).withColumn("upto", F.sum(size).over(upto)).filter(F.col("upto") <= max_bytes).drop("upto")


def _score_batches(shared):
    state: dict = {}

    def run(batches):
        model: Model = shared.value
        cache: dict[str, float] = state.setdefault("cache", {})
        for batch in batches:
            scores = []
            for part in text_parts(batch, max_bytes=1 << 20):
                texts = [tokens_of(t) for t in part.column("text").to_pylist()]
                new = {w for words in texts for w in words if w not in cache}
                if new:
                    if len(cache) + len(new) > CACHE_WORDS:
                        cache.clear()
                        new = {w for words in texts for w in words}
                    new = list(new)
                    cache.update(zip(new, model.word_logits([letters_of(w) for w in new]).tolist()))
                for words in texts:
                    logits = np.fromiter(map(cache.__getitem__, words), np.float64, len(words))
                    scores.append(model.score(model.text_logit(logits)))
            yield pa.record_batch([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "score"])
    return run


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Train on the bounded sample; the share of toxic labels is counted over all of them."""
    share = known_labels(labels).agg(F.avg("toxic")).first()[0]
    rows = sorted(training_rows(docs, labels, max_rows).collect(), key=lambda r: (r.doc_id, r.text or ""))
    texts, toxic = [r.text for r in rows], [r.toxic for r in rows]
    del rows
    return train(texts, toxic, share)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (any columns, ``text`` among them) with ``score`` in [0, 1]."""
    docs = docs.drop("score")
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_score_batches(shared), T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))


def keep_clean(docs: DataFrame, labels: DataFrame, limit: float = 0.5) -> DataFrame:
    """Rows of ``docs``, all their columns as they are, whose score is below ``limit``."""
    rows, back = aside(docs, "doc_id", "text")
    return back(score_documents(rows, fit(rows, labels)).filter(F.col("score") < limit))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_documents(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
