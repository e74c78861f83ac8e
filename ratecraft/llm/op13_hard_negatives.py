"""Hard-negative mining with bounds from the means and deviations of vector segments.

Components become integers, ``floor(256 * x)``. Each vector is cut into 1, 4
and 16 segments (``SEGMENTS``; finer cuts nest in coarser ones) and stored with
the mean and the standard deviation of every segment. For a segment of length
s, the inner product is s * mean * mean' plus a rest of at most
s * deviation * deviation' in either direction, so the sum over the segments
bounds the score from both sides. A block of anchors is compared with a block
of rows by the coarsest cut first; pairs whose interval misses what is asked
for are dropped, the others go on to the next cut, and what is left is scored
exactly in 64-bit integers.

1. Positives of an anchor: the ``N_POSITIVES`` best other rows of its label.
   A pair goes on while its upper bound reaches the anchor's worst kept
   positive.
2. Negatives of an anchor and a positive: the best ``N_NEGATIVES`` rows of
   another label with a score from 50 to 95 hundredths of the positive's. A pair
   goes on while its interval meets a window of one of the anchor's positives
   above the worst negative kept there.

Anchors are the stated query set. They go through in passes of at most
``PASS_BYTES`` (measured by count and length beforehand), each pass one scan of
all rows without a shuffle of vectors; a task keeps the best rows of its
anchors and returns those alone, and they are merged by anchor. Work is rows
times anchors, so rows with a hot label cost a task no more than others.

Defined cases: rows with a null id, a null label, a null or empty vector, or a
null or non-finite component take no part; vectors of different length are
never compared; components beyond +-2^24 after scaling count as +-2^24 (so no
score leaves 64 bits up to 16,384 dimensions); repeated rows are rows of their own, also as anchors;
equal scores go by smaller id; an anchor without other rows of its label, or
whose windows hold no row, gives no rows; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratecraft.llm.common import ship, table
from ratecraft.session import materialize

SEGMENTS = (1, 4, 16)
SCALE = 256
LIMIT = 1 << 24
N_POSITIVES = 5
N_NEGATIVES = 3
LOW, HIGH = 50, 95              # hundredths of the positive's score
ANCHOR_EVERY = 50
PASS_BYTES = 16 << 20
ANCHOR_BLOCK, ROW_BLOCK = 512, 4096
DENSE = 0.1                     # share of pairs from which on bounds are computed for the whole block
CHUNK = 1 << 16
SEED = 13
FAR = np.int64(1) << 62


def cuts(dim: int, segments: int) -> np.ndarray:
    """Starts of the segments of a vector of length ``dim`` (empty segments left out) and its end."""
    return np.unique(np.arange(segments + 1) * dim // segments)


def summary(x: np.ndarray) -> np.ndarray:
    """Means and deviations, weighted by the root of the segment's length, of all cuts: (n, 2 * segments in all)."""
    out = []
    for s in SEGMENTS:
        at = cuts(x.shape[1], s)
        n = np.diff(at)
        mean = np.add.reduceat(x, at[:-1], axis=1) / n
        square = np.add.reduceat((x - np.repeat(mean, n, axis=1)) ** 2, at[:-1], axis=1)
        out += [mean * np.sqrt(n), np.sqrt(square)]
    return np.concatenate(out, axis=1)


class Block:
    """Vectors of one length with their segment summaries."""

    def __init__(self, ids, rows, labels, vectors: np.ndarray, summaries: np.ndarray):
        self.ids, self.rows, self.labels, self.vectors, self.summaries = ids, rows, labels, vectors, summaries
        self.norms = np.sqrt(np.einsum("ij,ij->i", vectors.astype(np.float64), vectors.astype(np.float64)))

    def __len__(self):
        return len(self.ids)

    def take(self, at) -> "Block":
        return Block(self.ids[at], self.rows[at], self.labels[at], self.vectors[at], self.summaries[at])

    def level(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        n = [len(cuts(self.vectors.shape[1], s)) - 1 for s in SEGMENTS]
        at = 2 * sum(n[:k])
        return self.summaries[:, at:at + n[k]], self.summaries[:, at + n[k]:at + 2 * n[k]]


def candidates(a: Block, b: Block, allowed: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of ``allowed`` whose score may lie in [low[i], high[i]], segments refined step by step."""
    i = j = None
    for k in range(len(SEGMENTS)):
        (m, d), (m2, d2) = a.level(k), b.level(k)
        if i is None:
            # summaries are 32-bit floats: their rounding stays far below this share of the norms' product
            mid, rest = m @ m2.T, d @ d2.T + 1e-5 * np.outer(a.norms, b.norms) + 1e-3
            allowed = allowed & (mid + rest >= low[:, None]) & (mid - rest <= high[:, None])
            if k == len(SEGMENTS) - 1 or allowed.mean() < DENSE:
                i, j = np.nonzero(allowed)
            continue
        keep = []
        for lo in range(0, len(i), CHUNK):
            x, y = i[lo:lo + CHUNK], j[lo:lo + CHUNK]
            mid = np.einsum("ij,ij->i", m[x], m2[y])
            rest = np.einsum("ij,ij->i", d[x], d2[y]) + 1e-5 * a.norms[x] * b.norms[y] + 1e-3
            keep.append((mid + rest >= low[x]) & (mid - rest <= high[x]))
        keep = np.concatenate(keep) if keep else np.zeros(0, bool)
        i, j = i[keep], j[keep]
    return i, j


def scores(a: Block, b: Block, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i), np.int64)
    for lo in range(0, len(i), CHUNK):
        x, y = i[lo:lo + CHUNK], j[lo:lo + CHUNK]
        out[lo:lo + CHUNK] = np.einsum("ij,ij->i", a.vectors[x], b.vectors[y])
    return out


class Best:
    """The ``k`` best (score, id, row) of each of ``n`` slots, best first; ties by smaller id, then row."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.slot, self.score, self.ids, self.rows = (np.zeros(0, np.int64) for _ in range(4))
        self.least = np.full(n, -FAR)          # what a new row has to reach

    def add(self, slot, score, ids, rows):
        keep = score >= self.least[slot]
        if not keep.any():
            return
        slot, score, ids, rows = (np.concatenate([old, new[keep]]) for old, new in
                                  ((self.slot, slot), (self.score, score), (self.ids, ids), (self.rows, rows)))
        order = np.lexsort((rows, ids, -score, slot))
        slot = slot[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        order, slot, rank = order[rank < self.k], slot[rank < self.k], rank[rank < self.k]
        self.slot, self.score, self.ids, self.rows = slot, score[order], ids[order], rows[order]
        full = rank == self.k - 1
        self.least[slot[full]] = self.score[full]


def windows(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest negative score of a positive's score (lowest > highest: none)."""
    return -((-LOW * positive) // 100), (HIGH * positive) // 100


def _blocks(batches):
    """Blocks of equal dimension of the stored rows."""
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            for lo in range(0, len(at), ROW_BLOCK):
                t = batch.take(pa.array(at[lo:lo + ROW_BLOCK]))
                raw = lambda c, kind: np.frombuffer(b"".join(t.column(c).to_pylist()), kind).reshape(t.num_rows, -1)  # noqa: E731,B023
                yield int(dim), Block(t.column("vec_id").to_numpy(), t.column("row").to_numpy(), t.column("label").to_numpy(),
                                      raw("vec", "<i4").astype(np.int64), raw("segments", "<f4"))


def _summarise(batches):
    names = ["vec_id", "row", "label", "dim", "vec", "segments"]
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            t = batch.take(pa.array(np.flatnonzero(dims == dim)))
            x = t.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, int(dim))
            packed = [pa.array([r.tobytes() for r in a], pa.binary()) for a in (x.astype("<i4"), summary(x.astype(np.float64)).astype("<f4"))]
            yield pa.record_batch([t.column(c) for c in names[:4]] + packed, names=names)


_STORED = "vec_id long, row long, label long, dim int, vec binary, segments binary"


def store_segments(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label: F.Column | None = None) -> DataFrame:
    """The usable rows as a written table: vec_id, row (a number of its own), label, dim, integer vector, segment summaries."""
    ship(vectors.sparkSession)
    x = F.col(vec_col).cast("array<double>")
    finite = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), F.lit(False)))
    scaled = F.transform(x, lambda v: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(F.greatest(
        F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), F.lit(float(SCALE)) * v))))).cast("int"))
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), (F.col("label") if label is None else label).cast("long").alias("label"),
                           F.when(finite & (F.size(x) > 0), scaled).alias("vec"))
            .filter("vec_id is not null and label is not null and vec is not null")
            .select("vec_id", F.monotonically_increasing_id().alias("row"), "label", F.size("vec").alias("dim"), "vec"))
    return materialize(rows.mapInArrow(_summarise, _STORED), "segments")


def _anchor_blocks(rows: list) -> dict[int, list[Block]]:
    """Blocks of anchors per dimension, sorted by label so that a block holds few labels."""
    out: dict[int, list[Block]] = {}
    rows = sorted(rows, key=lambda r: (r.dim, r.label, r.vec_id, r.row))
    for dim in sorted({r.dim for r in rows}):
        own = [r for r in rows if r.dim == dim]
        for lo in range(0, len(own), ANCHOR_BLOCK):
            p = own[lo:lo + ANCHOR_BLOCK]
            col = lambda c: np.array([getattr(r, c) for r in p], np.int64)  # noqa: E731,B023
            out.setdefault(dim, []).append(Block(
                col("vec_id"), col("row"), col("label"), np.frombuffer(b"".join(r.vec for r in p), "<i4").reshape(len(p), -1).astype(np.int64),
                np.frombuffer(b"".join(r.segments for r in p), "<f4").reshape(len(p), -1)))
    return out


_HITS = "anchor long, slot int, vec_id long, row long, score long"


def _hits(anchors: Block, slots: int, best: Best) -> pa.RecordBatch:
    return pa.record_batch([pa.array(anchors.rows[best.slot // slots]), pa.array((best.slot % slots).astype(np.int32)), pa.array(best.ids),
                            pa.array(best.rows), pa.array(best.score)], names=["anchor", "slot", "vec_id", "row", "score"])


def _mine_positives(shared):
    def run(batches):
        anchors = shared.value
        best = {(dim, k): Best(len(a), N_POSITIVES) for dim, blocks in anchors.items() for k, a in enumerate(blocks)}
        for dim, rows in _blocks(batches):
            for k, a in enumerate(anchors.get(dim, [])):
                own = best[dim, k]
                allowed = (a.labels[:, None] == rows.labels[None, :]) & (a.rows[:, None] != rows.rows[None, :])
                if allowed.any():
                    i, j = candidates(a, rows, allowed, own.least, np.full(len(a), FAR))
                    own.add(i, scores(a, rows, i, j), rows.ids[j], rows.rows[j])
        for (dim, k), own in best.items():
            yield _hits(anchors[dim][k], 1, own)
    return run


def _mine_negatives(shared):
    def run(batches):
        anchors, low, high = shared.value      # low, high: per block (anchors, positives), none: low > high
        best = {(dim, k): Best(len(a) * N_POSITIVES, N_NEGATIVES) for dim, blocks in anchors.items() for k, a in enumerate(blocks)}
        for dim, rows in _blocks(batches):
            for k, a in enumerate(anchors.get(dim, [])):
                own, lo, hi = best[dim, k], low[dim, k], high[dim, k]
                open_ = lo <= hi
                floor = np.maximum(lo, own.least.reshape(lo.shape))
                least = np.where(open_, floor, FAR).min(axis=1)
                most = np.where(open_, hi, -FAR).max(axis=1)
                allowed = (a.labels[:, None] != rows.labels[None, :]) & (least <= most)[:, None]
                if not allowed.any():
                    continue
                i, j = candidates(a, rows, allowed, least, most)
                s = scores(a, rows, i, j)
                inside = (s >= least[i]) & (s <= most[i])
                i, j, s = i[inside], j[inside], s[inside]
                for p in range(N_POSITIVES):
                    fits = (s >= floor[i, p]) & (s <= hi[i, p])
                    own.add(i[fits] * N_POSITIVES + p, s[fits], rows.ids[j[fits]], rows.rows[j[fits]])
        for (dim, k), own in best.items():
            yield _hits(anchors[dim][k], N_POSITIVES, own)
    return run


def _first(hits: DataFrame, n: int) -> DataFrame:
    """The ``n`` best hits of each (anchor, slot), numbered from 1 in ``rank``."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "vec_id", "row")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def hard_negatives(stored: DataFrame, anchor: F.Column, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score over a table of ``store_segments``.

    ``anchor`` says which rows are anchors.
    """
    spark = stored.sparkSession
    queries = stored.filter(anchor)
    size = F.octet_length("vec") + F.octet_length("segments") + F.lit(64)
    passes = max(1, -(-int(queries.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]) // pass_bytes))
    out = None
    for k in range(passes):
        own = queries.filter(F.pmod(F.xxhash64("row", F.lit(SEED)), F.lit(passes)) == k)
        anchors = _anchor_blocks(own.collect())          # at most about pass_bytes
        hits = stored.mapInArrow(_mine_positives(spark.sparkContext.broadcast(anchors)), _HITS)
        positives = materialize(_first(hits, N_POSITIVES), "positives")
        low, high = {}, {}
        found = {(r.anchor, r.rank): r.score for r in positives.select("anchor", "rank", "score").collect()}
        for dim, blocks in anchors.items():
            for b, a in enumerate(blocks):
                ps = np.array([[found.get((int(r), p + 1), -1) for p in range(N_POSITIVES)] for r in a.rows], np.int64)
                low[dim, b], high[dim, b] = windows(ps)     # a negative positive's window is empty, as is a missing one's
        negatives = _first(stored.mapInArrow(_mine_negatives(spark.sparkContext.broadcast((anchors, low, high))), _HITS), N_NEGATIVES)
        names = stored.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")).join(
            positives.select("anchor").distinct(), "anchor", "left_semi")
        chosen = positives.select("anchor", (F.col("rank") - 1).cast("int").alias("slot"), F.col("vec_id").alias("positive_id"),
                                  F.col("score").alias("positive_score"))
        part = (negatives.select("anchor", "slot", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
                .join(chosen, ["anchor", "slot"]).join(names, "anchor")
                .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
        part = part if passes == 1 else materialize(part, "hard-negatives")
        out = part if out is None else out.unionByName(part)
    return out


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(store_segments(vectors, label=label), F.col("vec_id") % ANCHOR_EVERY == 0)
