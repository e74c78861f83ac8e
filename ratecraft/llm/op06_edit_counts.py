"""Edit-aware token counts from per-document segment trees.

A text is cut into leaves of about ``LEAF`` characters, each a whole number of
pre-tokens: cuts are made before a single space between two non-space
characters, where the tokenizer's pre-token pattern always starts anew. A
leaf keeps its characters and its token count; a binary tree over the leaves
keeps their sums, so the count of a document is its root.

An edit replaces the characters [start, start + n_delete) by a string. The tree
finds the leaves that hold the range and the two characters before and one
after it (the context that a cut depends on). Only their text is encoded
again; it fills the same slots, the sums on the paths to the root are brought
up to date, and everything else stays. A slot that grows to ``GROWN`` leaves
has the tree laid out anew from the counts that are known.

``build_trees`` adds the tree to each row as two arrays, so a later run edits
without encoding the document; ``apply_edits`` returns the new text, tree and
counts. The edits of one document depend on each other and are applied in
order by one task; documents are independent.

Defined cases: a null text is an empty one (one empty leaf, count 0); a null or
empty edit list changes nothing; start and n_delete are clipped to the text of
that moment (null: 0); a null insertion is empty; repeated rows are edited each
by itself; columns named like the added ones are replaced.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecraft.llm.common import ship, table
from ratecraft.llm.pieces import encoder

LEAF = 512
GROWN = 8
_CUT = re.compile(r"(?<=\S) (?=\S)")


def leaves_of(text: str, size: int = LEAF) -> list[str]:
    """The text in leaves of at least ``size`` characters, cut at safe places (one leaf at least)."""
    out, at = [], 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if cut is None:
            break
        out.append(text[at:cut.start()])
        at = cut.start()
    out.append(text[at:])
    return out


class CountTree:
    """Leaves with characters and token counts, and a binary tree of their sums."""

    def __init__(self, texts: list[str], counts: list[int], count):
        self.count = count                       # function text -> tokens
        self.encoded_chars = 0                   # characters encoded by edits
        self.encoded_leaves = 0
        self._lay(texts, counts)

    @classmethod
    def of(cls, text: str, count) -> "CountTree":
        leaves = leaves_of(text)
        return cls(leaves, [count(x) for x in leaves], count)

    @classmethod
    def restore(cls, text: str, chars: list[int], tokens: list[int], count) -> "CountTree":
        texts, at = [], 0
        for n in chars:
            texts.append(text[at:at + n])
            at += n
        return cls(texts, list(tokens), count)

    def _lay(self, texts: list[str], counts: list[int]) -> None:
        self.texts = texts
        self.size = 1 << max(0, len(texts) - 1).bit_length()
        self.chars = [0] * (2 * self.size)
        self.tokens = [0] * (2 * self.size)
        self.chars[self.size:self.size + len(texts)] = [len(x) for x in texts]
        self.tokens[self.size:self.size + len(texts)] = counts
        for i in range(self.size - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(self.texts)

    def leaf_tokens(self) -> list[int]:
        return self.tokens[self.size:self.size + len(self.texts)]

    def _leaf(self, at: int) -> tuple[int, int]:
        """(leaf that holds character ``at``, its first character), by descent."""
        i, first = 1, 0
        while i < self.size:
            i *= 2
            if at >= first + self.chars[i]:
                first += self.chars[i]
                i += 1
        return i - self.size, first

    def _put(self, leaf: int, text: str, tokens: int) -> None:
        self.texts[leaf] = text
        i = leaf + self.size
        d_chars, d_tokens = len(text) - self.chars[i], tokens - self.tokens[i]
        while i:
            self.chars[i] += d_chars
            self.tokens[i] += d_tokens
            i //= 2

    def edit(self, start: int, n_delete: int, insertion: str) -> None:
        total = self.n_chars
        start = min(max(start, 0), total)
        end = min(start + max(n_delete, 0), total)
        if total:
            a, first = self._leaf(max(start - 2, 0))
            b, last = self._leaf(min(end, total - 1))
        else:
            a, first, b, last = 0, 0, 0, 0
        old = "".join(self.texts[a:b + 1])
        new = old[:start - first] + insertion + old[end - first:]
        fresh = leaves_of(new) if new else [""]
        counts = [self.count(x) for x in fresh]
        self.encoded_chars += len(new)
        self.encoded_leaves += len(fresh)
        slots = b - a + 1
        if len(fresh) > slots:
            rest, known = fresh[slots - 1:], counts[slots - 1:]
            if sum(map(len, rest)) > GROWN * LEAF:
                at = self.leaf_tokens()
                self._lay(self.texts[:a] + fresh + self.texts[b + 1:], at[:a] + counts + at[b + 1:])
                return
            fresh, counts = [*fresh[:slots - 1], "".join(rest)], [*counts[:slots - 1], sum(known)]
        for k in range(slots):
            self._put(a + k, *((fresh[k], counts[k]) if k < len(fresh) else ("", 0)))


def _counter(tokenizer: str | None):
    enc = encoder(tokenizer)
    return lambda text: len(enc.encode(text)) // enc.width


def _build(tokenizer: str | None):
    def run(batches):
        count = _counter(tokenizer)
        for batch in batches:
            chars, tokens = [], []
            for text in batch.column("text").to_pylist():
                leaves = leaves_of(text or "")
                chars.append([len(x) for x in leaves])
                tokens.append([count(x) for x in leaves])
            yield pa.record_batch([*batch.columns, pa.array(chars, pa.list_(pa.int32())), pa.array(tokens, pa.list_(pa.int32())),
                                   pa.array([sum(x) for x in tokens], pa.int64())],
                                  names=[*batch.schema.names, "leaf_chars", "leaf_tokens", "n_tokens"])
    return run


_TREE = [T.StructField("leaf_chars", T.ArrayType(T.IntegerType())), T.StructField("leaf_tokens", T.ArrayType(T.IntegerType())),
         T.StructField("n_tokens", T.LongType())]
_EDITED = [T.StructField("n_tokens_after", T.LongType()), T.StructField("n_chars_after", T.LongType()),
           T.StructField("n_edits", T.LongType()), T.StructField("encoded_chars", T.LongType()),
           T.StructField("encoded_leaves", T.LongType())]


def build_trees(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``docs`` (any columns, ``text`` among them) with leaf_chars, leaf_tokens and n_tokens."""
    ship(docs.sparkSession)
    docs = docs.drop(*[f.name for f in _TREE])
    return docs.mapInArrow(_build(tokenizer), T.StructType([*docs.schema.fields, *_TREE]))


def _apply(tokenizer: str | None):
    def run(batches):
        count = _counter(tokenizer)
        for batch in batches:
            names = batch.schema.names
            out = {f.name: [] for f in _EDITED}
            texts, chars, tokens = [], [], []
            for text, edits, c, t in zip(*(batch.column(x).to_pylist() for x in ("text", "edits", "leaf_chars", "leaf_tokens"))):
                tree = CountTree.restore(text or "", c, t, count)
                for e in edits or []:
                    tree.edit(e["start"] or 0, e["n_delete"] or 0, e["insertion"] or "")
                texts.append(tree.text())
                chars.append([len(x) for x in tree.texts])
                tokens.append(tree.leaf_tokens())
                for k, v in zip(out, (tree.n_tokens, tree.n_chars, len(edits or []), tree.encoded_chars, tree.encoded_leaves)):
                    out[k].append(v)
            new = {"text": pa.array(texts, pa.string()), "leaf_chars": pa.array(chars, pa.list_(pa.int32())),
                   "leaf_tokens": pa.array(tokens, pa.list_(pa.int32()))}
            columns = [new.get(n, batch.column(n)) for n in names]
            yield pa.record_batch([*columns, *[pa.array(v, pa.int64()) for v in out.values()]], names=[*names, *out])
    return run


def apply_edits(trees: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Rows of ``build_trees`` with a column ``edits`` (array of start, n_delete, insertion), edited.

    text, leaf_chars and leaf_tokens are those after the edits; n_tokens stays
    the count before, n_tokens_after is the count after.
    """
    ship(trees.sparkSession)
    trees = trees.drop(*[f.name for f in _EDITED])
    schema = T.StructType([*trees.schema.fields, *_EDITED])
    return trees.mapInArrow(_apply(tokenizer), schema)


def derived_edits(n: int = 3) -> F.Column:
    """``n`` edits of each document, fixed by its id: a hashed place loses up to 59
    characters and gets up to 79 characters of the document's own text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.length(text)
    draw = lambda k, m: F.pmod(F.xxhash64(F.col("doc_id"), F.lit(k)), m.cast("long"))
    return F.array(*[
        F.struct(draw(4 * k, size + 1).alias("start"), draw(4 * k + 1, F.lit(60)).alias("n_delete"),
                 F.substr(text, (draw(4 * k + 2, size + 1) + 1).cast("int"), draw(4 * k + 3, F.lit(80)).cast("int")).alias("insertion"))
        for k in range(n)])


def op6_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("edits", derived_edits())
    return apply_edits(build_trees(docs)).select(
        "doc_id", "n_tokens", "n_tokens_after", "n_chars_after", "n_edits", "encoded_chars", "encoded_leaves",
        F.size("leaf_tokens").cast("long").alias("n_leaves"))
