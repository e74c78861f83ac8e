"""Ranked search over K2-treaps: quadtrees of the term-document grid with impact maxima.

Index. Documents are dealt into shards of about ``SHARD_TOKENS`` words. A
shard is a grid with a row a term and a column a document; a cell holds the
impact of the term in the document, ``(10^9 * tf) div (1000 * tf + 20 * m)``, a
number that needs no term weight. The grid is a quadtree stored breadth first:
one bit a node says whether it holds a single cell, four bits which quadrants
of it are filled, and each node carries the maximum of its cells as the
difference to its parent's, in as few bytes as its level needs. A node of one
cell ends its branch and stores the rest of the cell's coordinates, so no
chain of single nodes is kept. Rows are ordered by their largest impact and
columns by their most frequent term, so that quadrants hold alike cells.

Search. For an item, the row paths of its terms go down together: a state is a
range of documents with the quadtree node of every term's row over that range,
and its bound is the sum of weight times node maximum. States are opened best
first (some hundred at a time, in numpy); a state of one document has its exact
score as bound. Ranges whose bound is below the worst of the ``k`` best scores
so far, also of earlier shards of the task, are never opened. Results are
exact.

Weights need the number of documents that hold a term: shards store it per
term, and only terms of the items are summed up. Items are a stated query set:
they go through in blocks of at most ``ITEM_BYTES`` (measured beforehand), each
one pass over the index. A task returns its k best per item, which are merged.

Defined cases: a null or empty text has no terms and is never found; repeated
documents are documents of their own; a document without an id can be found
(doc_id null, last among equal scores); items with equal id and text are one
item, an item without an id is kept, one without a known term has no rows;
empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratecraft.llm.common import ship, table
from ratecraft.llm.op07_decontam import words_of
from ratecraft.session import materialize, scratch_path

K = 50
SHARD_TOKENS = 2 << 20
SHARD_DOCS = 1 << 16
ITEM_BYTES = 2 << 20
OPEN = 128                      # states opened at once until k documents are scored
OPEN_CELLS = 1 << 17            # then: nodes looked at in one step
_BITS = np.array([[bin(m & ((1 << c) - 1)).count("1") for c in range(4)] for m in range(16)], np.int32)
_COUNT = np.array([bin(m).count("1") for m in range(16)], np.int32)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def length_norm(n: int, n_docs: int, n_terms: int) -> int:
    return 50 + (50 * n * n_docs) // n_terms


def weight(n_docs: int, df: int) -> int:
    return floor(1000 * log((2 * n_docs + 2) / (2 * df + 1)))


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of x (below 2^32) at the even places of a 64-bit number."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def _gather(x: np.ndarray) -> np.ndarray:
    """Even bits of x, closed up."""
    x = x & np.uint64(0x5555555555555555)
    for shift, mask in ((1, 0x3333333333333333), (2, 0x0F0F0F0F0F0F0F0F), (4, 0x00FF00FF00FF00FF),
                        (8, 0x0000FFFF0000FFFF), (16, 0x00000000FFFFFFFF)):
        x = (x | (x >> np.uint64(shift))) & np.uint64(mask)
    return x.astype(np.int64)


def _pack(values: np.ndarray) -> bytes:
    """Non-negative integers in the fewest whole bytes that hold the largest (0 to 8)."""
    values = np.ascontiguousarray(values, "<u8")
    width = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    return struct.pack("<BQ", width, len(values)) + values.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpack(buf, at: int) -> tuple[np.ndarray, int]:
    width, n = struct.unpack_from("<BQ", buf, at)
    at += 9
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(buf, np.uint8, n * width, at).reshape(n, width)
    return out.view("<u8").ravel(), at + n * width


def encode_tree(row: np.ndarray, col: np.ndarray, value: np.ndarray) -> bytes:
    """The quadtree of distinct cells (row, col) with values above 0, breadth first."""
    height = max(int(row.max()), int(col.max()), 1).bit_length() if len(row) else 0
    z = (_spread(row) << np.uint64(1)) | _spread(col)
    order = np.argsort(z)
    z, v = z[order], value[order].astype(np.int64)
    out = [struct.pack("<BQ", height, len(z))]
    starts, parent_max = np.zeros(1 if len(z) else 0, np.int64), None
    for level in range(height + 1):
        if not len(starts):
            break
        size = np.diff(np.append(starts, len(z)))
        top = np.maximum.reduceat(v, starts)
        single = size == 1
        rest = z[starts[single]] & np.uint64((1 << (2 * (height - level))) - 1)
        out += [np.packbits(single, bitorder="little").tobytes(), _pack(top if parent_max is None else parent_max - top), _pack(rest)]
        inside = np.repeat(~single, size)
        z, v, owner = z[inside], v[inside], np.repeat(np.cumsum(~single) - 1, size)[inside]
        if not len(z):
            break
        code = z >> np.uint64(2 * (height - level - 1))
        starts = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        quadrant, owner = (code[starts] & np.uint64(3)).astype(np.int64), owner[starts]
        mask = np.bincount(owner, weights=1 << quadrant, minlength=int((~single).sum())).astype(np.uint8)
        mask = np.append(mask, np.zeros(len(mask) % 2, np.uint8))
        out.append((mask[::2] | (mask[1::2] << 4)).tobytes())
        parent_max = top[~single][owner]
    return b"".join(out)


class Tree:
    """Navigable form of an encoded quadtree: per node its quadrants, first child, maximum and, of a single cell, the cell."""

    def __init__(self, buf: bytes):
        self.height, n = struct.unpack_from("<BQ", buf)
        at, size = 9, 1 if n else 0
        prefix, parent_max = np.zeros(size, np.uint64), None
        masks, tops, rows, cols = [], [], [], []
        for level in range(self.height + 1):
            if not size:
                break
            n_bytes = (size + 7) // 8
            single = np.unpackbits(np.frombuffer(buf, np.uint8, n_bytes, at), bitorder="little")[:size].astype(bool)
            diff, at = _unpack(buf, at + n_bytes)
            rest, at = _unpack(buf, at)
            top = diff.astype(np.int64) if parent_max is None else parent_max - diff.astype(np.int64)
            cell = (prefix[single] << np.uint64(2 * (self.height - level))) | rest
            row, col = np.full(size, -1, np.int32), np.full(size, -1, np.int32)
            row[single], col[single] = _gather(cell >> np.uint64(1)), _gather(cell)
            inner, mask = int((~single).sum()), np.zeros(size, np.uint8)
            if inner:
                packed = np.frombuffer(buf, np.uint8, (inner + 1) // 2, at)
                at += len(packed)
                mask[~single] = np.stack([packed & 15, packed >> 4], 1).ravel()[:inner]
            masks.append(mask)
            tops.append(top)
            rows.append(row)
            cols.append(col)
            filled = ((mask[:, None] >> np.arange(4, dtype=np.uint8)) & 1).astype(bool)
            parent, quadrant = np.nonzero(filled)
            prefix, parent_max, size = (prefix[parent] << np.uint64(2)) | quadrant.astype(np.uint64), top[parent], len(parent)
        join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        self.mask, self.top, self.row, self.col = join(masks, np.uint8), join(tops, np.int64), join(rows, np.int32), join(cols, np.int32)
        self.first = (1 + np.cumsum(_COUNT[self.mask]) - _COUNT[self.mask]).astype(np.int64)


class Results:
    """The k best (score, doc id) so far; ties by smaller id, null last."""

    def __init__(self, k: int):
        self.k, self.score, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """Score that a document has to reach."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -score))[:self.k]
        self.score, self.ids = score[order], ids[order]


def descend(tree: Tree, rows: np.ndarray, weights: np.ndarray, doc_ids: np.ndarray, results: Results) -> int:
    """Search one shard for the terms at ``rows``; returns the number of states opened."""
    if not len(tree.mask) or not len(rows):
        return 0
    last, opened = tree.height, 0
    root = np.where((tree.row[0] < 0) | (tree.row[0] == rows), 0, -1)[None, :]
    level, nodes = np.zeros(1, np.int64), root
    bound = np.where(nodes >= 0, tree.top[0] * weights, 0).sum(axis=1)
    wide = max(OPEN, OPEN_CELLS // len(rows))
    while len(bound):
        batch = OPEN if len(results.score) < results.k else wide
        if len(bound) > batch:
            part = np.argpartition(-bound, batch)
            now, later = part[:batch], part[batch:]
        else:
            now, later = np.arange(len(bound)), np.zeros(0, np.int64)
        opened += len(now)
        at, depth = nodes[now], level[now]
        shift = (last - 1 - depth)[:, None]
        leaf = tree.col[at]                                 # of node -1: some value, masked below
        is_leaf, quarters, start = (at >= 0) & (leaf >= 0), tree.mask[at], tree.first[at]
        row_bit = (rows[None, :] >> shift) & 1
        new_nodes, new_level = [], []
        for half in (0, 1):
            quadrant = 2 * row_bit + half
            below = (at >= 0) & ~is_leaf & ((quarters >> quadrant.astype(np.uint8)) & 1).astype(bool)
            child = np.where(below, start + _BITS[quarters, quadrant], -1)
            child = np.where(below & (tree.row[child] >= 0) & (tree.row[child] != rows[None, :]), -1, child)
            child = np.where(is_leaf & (((leaf >> shift) & 1) == half), at, child)
            new_nodes.append(child)
            new_level.append(depth + 1)
        child, depth = np.concatenate(new_nodes), np.concatenate(new_level)
        there = child >= 0
        top = np.where(there, tree.top[child] * weights, 0).sum(axis=1)
        # one document is left when all its nodes are single cells of one column
        cell = np.where(there, tree.col[child], -1)
        most = cell.max(axis=1)
        done = (most >= 0) & (~there | (cell == most[:, None])).all(axis=1)
        good = done & (top >= results.least)
        if good.any():
            results.add(top[good], doc_ids[most[good]])
        keep = ~done & (top >= results.least)
        stay = later[bound[later] >= results.least]
        nodes, level, bound = (np.concatenate([a[stay], b[keep]]) for a, b in ((nodes, child), (level, depth), (bound, top)))
    return opened


class _Terms(dict):
    def __missing__(self, word):
        self[word] = len(self)
        return self[word]


NO_ID = np.iinfo(np.int64).max          # a null doc_id in a shard: behind every other among equal scores


class ShardBuilder:
    """Collects the documents of one shard; words are kept as numbers."""

    def __init__(self, n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms
        self.terms, self.docs, self.words, self.tokens = _Terms(), [], [], 0

    def add(self, doc_id: int | None, words: list[bytes]) -> None:
        if words:
            self.docs.append(NO_ID if doc_id is None else doc_id)
            self.words.append(np.fromiter(map(self.terms.__getitem__, words), np.int32, len(words)))
            self.tokens += len(words)

    def row(self) -> dict:
        size = np.array([len(w) for w in self.words], np.int64)
        n, names = len(size), list(self.terms)
        key, tf = np.unique((np.repeat(np.arange(n), size) << 32) | np.concatenate(self.words), return_counts=True)
        doc, term = key >> 32, key & 0xFFFFFFFF
        m = np.array([min(length_norm(int(x), self.n_docs, self.n_terms), 1 << 56) for x in size], np.int64)
        value = impact(tf.astype(np.int64), m[doc])
        df = np.bincount(term, minlength=len(names))
        best = np.zeros(len(names), np.int64)
        np.maximum.at(best, term, value)
        order = np.lexsort((-df, -best))                   # rows: terms of high impact first
        row_of = np.empty(len(names), np.int64)
        row_of[order] = np.arange(len(names))
        common, top_tf = np.full(n, len(names), np.int64), np.zeros(n, np.int64)
        np.maximum.at(top_tf, doc, tf)                     # columns: documents with the same most frequent term together
        at = tf == top_tf[doc]
        np.minimum.at(common, doc[at], term[at])
        place = np.lexsort((size, common))
        col_of = np.empty(n, np.int64)
        col_of[place] = np.arange(n)
        keep = value > 0
        return {"n_docs": n, "terms": zlib.compress(b"\n".join([names[i] for i in order]), 1),
                "df": zlib.compress(df[order].astype("<u4").tobytes(), 1), "docs": np.array(self.docs, "<i8")[place].tobytes(),
                "tree": encode_tree(row_of[term[keep]], col_of[doc[keep]], value[keep])}


_SHARD = "n_docs long, terms binary, df binary, docs binary, tree binary"
_SHARD_TYPES = pa.schema([("n_docs", pa.int64()), ("terms", pa.binary()), ("df", pa.binary()), ("docs", pa.binary()), ("tree", pa.binary())])


def _index_partition(n_docs: int, n_terms: int, shard_tokens: int):
    def run(batches):
        shard = ShardBuilder(n_docs, n_terms)
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for i in range(batch.num_rows):
                shard.add(ids[i].as_py(), words_of(texts[i].as_py()))
                if shard.tokens >= shard_tokens or len(shard.docs) >= SHARD_DOCS:
                    yield pa.RecordBatch.from_pylist([shard.row()], _SHARD_TYPES)
                    shard = ShardBuilder(n_docs, n_terms)
        if shard.docs:
            yield pa.RecordBatch.from_pylist([shard.row()], _SHARD_TYPES)
    return run


def _count_terms(batches):
    docs = terms = 0
    for batch in batches:
        for text in batch.column("text"):
            n = len(words_of(text.as_py()))
            docs, terms = docs + (n > 0), terms + n
    yield pa.record_batch([pa.array([docs], pa.int64()), pa.array([terms], pa.int64())], names=["docs", "terms"])


class Index:
    """A written index: its folder, the number of documents with terms and of their terms."""

    def __init__(self, spark: SparkSession, path: str, n_docs: int, n_terms: int):
        self.spark, self.path, self.n_docs, self.n_terms = spark, path, n_docs, n_terms

    @property
    def shards(self) -> DataFrame:
        return self.spark.read.parquet(self.path)


def build_index(docs: DataFrame, path: str | None = None, shard_tokens: int = SHARD_TOKENS) -> Index:
    """Index ``docs`` (doc_id, text) in ``path``."""
    spark = docs.sparkSession
    ship(spark)
    path = path or scratch_path(spark, "treaps")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = (rows.select("text").mapInArrow(_count_terms, "docs long, terms long")
             .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("docs", "terms")]).first())
    rows.mapInArrow(_index_partition(total.docs, max(total.terms, 1), shard_tokens), _SHARD).write.mode("overwrite").parquet(path)
    return Index(spark, path, total.docs, total.terms)


def _term_counts(wanted):
    def run(batches):
        for batch in batches:
            for terms, df in zip(batch.column("terms"), batch.column("df")):
                names = zlib.decompress(terms.as_py()).split(b"\n")
                at = [i for i, t in enumerate(names) if t in wanted.value]
                counts = np.frombuffer(zlib.decompress(df.as_py()), "<u4")
                yield pa.record_batch([pa.array([names[i] for i in at], pa.binary()), pa.array(counts[at].astype(np.int64))], names=["term", "df"])
    return run


def _search_shards(shared, k: int):
    def run(batches):
        items = shared.value                     # [(item number, [(term, weight)])]
        wanted = {t for _, terms in items for t, _ in terms}
        found = {number: Results(k) for number, _ in items}
        for batch in batches:
            for r in range(batch.num_rows):
                names = zlib.decompress(batch.column("terms")[r].as_py()).split(b"\n")
                row_of = {t: i for i, t in enumerate(names) if t in wanted}
                tree = Tree(batch.column("tree")[r].as_py())
                doc_ids = np.frombuffer(batch.column("docs")[r].as_py(), "<i8")
                for number, terms in items:
                    here = [(row_of[t], w) for t, w in terms if t in row_of]
                    if here:
                        rows, weights = (np.array(x, np.int64) for x in zip(*here))
                        descend(tree, rows, weights, doc_ids, found[number])
        for number, res in found.items():
            if len(res.score):
                ids = pa.array(res.ids, pa.int64(), mask=res.ids == NO_ID)
                yield pa.record_batch([pa.array(np.full(len(res.ids), number), pa.int64()), ids, pa.array(res.score)],
                                      names=["number", "doc_id", "score"])
    return run


def search(index: Index, items: DataFrame, k: int = K, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score of the ``k`` best documents of each item (item_id, text)."""
    spark = index.spark
    own = materialize(items.select("item_id", "text").distinct(), "search-items")
    size = int(own.agg(F.coalesce(F.sum(F.octet_length("text") + F.lit(64)), F.lit(0))).first()[0])
    blocks = max(1, -(-size // item_bytes))
    out = None
    for b in range(blocks):
        block = own.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()     # at most about item_bytes
        terms = [sorted(set(words_of(r.text))) for r in block]
        wanted = spark.sparkContext.broadcast({t for ts in terms for t in ts})
        counts = index.shards.select("terms", "df").mapInArrow(_term_counts(wanted), "term binary, df long")
        weights = {bytes(r.term): weight(index.n_docs, r.df) for r in counts.groupBy("term").agg(F.sum("df").alias("df")).collect()}
        shared = spark.sparkContext.broadcast([(i, [(t, weights[t]) for t in ts if weights.get(t, 0) > 0]) for i, ts in enumerate(terms)])
        hits = index.shards.select("terms", "docs", "tree").mapInArrow(_search_shards(shared, k), "number long, doc_id long, score long")
        order = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        best = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        ids = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(block)], f"number long, item_id {items.schema['item_id'].dataType.simpleString()}")
        part = best.join(ids, "number").select("item_id", "rank", "doc_id", "score")
        part = part if blocks == 1 else materialize(part, "search-hits")
        out = part if out is None else out.unionByName(part)
    return out


def op12_treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return search(index, table(spark, sf_dir, "benchmark").select("item_id", "text"))
