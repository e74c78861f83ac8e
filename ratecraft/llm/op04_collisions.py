"""Near-duplicate vectors by collision counting over sorted one-dimensional projections.

Vectors of one label (and length) are compared by cosine in double precision,
each divided by its largest absolute component first, so no norm leaves the
range of doubles.

1. Equal vectors of a label form one class with a number, a weight and a
   smallest id; copies are never paired with each other.
2. A class is projected on ``M`` random directions; the places are kept as one
   byte each. A label of at most ``CELL`` classes is one cell. A larger one is
   dealt into cells by the signs of k further projections, ``R`` times over with
   other directions: two unit vectors at the limit agree in a sign with
   probability p = 1 - angle / pi, so R = log(miss) / log(1 - p^k) tables leave
   out ``MISS`` of such pairs.
3. In a cell the first ``SORTED`` projections are sorted. A query takes the
   window of half width ``WIDTH`` standard deviations (of a pair at the limit)
   around its place out of each sorted projection and counts how often each class
   falls into it. Pairs with ``required(SORTED)`` collisions have the windows of
   the other projections counted as well, and ``required(M)`` of all make a
   candidate; ``MISS`` of the pairs at the limit fall short of either.
4. Cells are dealt into blocks of ``BLOCK`` classes, and block pairs are the unit
   of work, so a cell of any size is split over tasks. Only numbers and places
   (about ``M`` + 40 bytes a class) travel to the counting. A unit names the
   classes that have a candidate there; only those get their vector, by a join,
   and the unit counts them again and takes the cosine of the candidate pairs. A
   pair that met in an earlier table, by the signs of its vectors, is counted
   there alone. A task returns one row a linked class (links, and the smallest
   number of its connected part), never the pairs; parts are joined by
   union-find.

Defined cases: vectors that are null, empty, zero or hold null, NaN or infinite
components, and rows without a label or an id, link with nothing (n_links 0;
component_id is the own id); vectors of different length never link; repeated
rows are vectors of their own, also where one id stands for several vectors; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from math import acos, ceil, comb, erf, log, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.llm.common import components, ship, table
from ratecraft.llm.op05_superminhash import in_blocks, runs, smallest_of_part
from ratecraft.session import materialize

COSINE = 0.93
MISS = 1e-5
CELL = 8192
M = 64
SORTED = 20                 # projections counted by sorted windows, the others for pairs that pass these
WIDTH = 2.0
STEPS = 16                  # places a window's half width is divided into
BLOCK = 4096
QUERIES = 64                # counted at once
SEED = 20
MAX_BITS = 40


def tables_for(bits: int, cosine: float = COSINE, miss: float = MISS) -> int:
    """Tables that leave out ``miss`` of the pairs at the limit."""
    p = (1 - acos(cosine) / pi) ** bits
    return 1 if p >= 1 else max(1, ceil(log(miss) / log(1 - p)))


def window(cosine: float = COSINE, width: float = WIDTH) -> float:
    """Half width: ``width`` standard deviations of a projected difference at the limit."""
    return width * sqrt(2 - 2 * cosine)


def required(m: int = M, width: float = WIDTH, miss: float = MISS / 2) -> int:
    """Largest count over ``m`` projections that all but ``miss`` of the pairs at the limit reach."""
    p = erf(width / sqrt(2))
    short = 0.0
    for count in range(m + 1):
        short += comb(m, count) * p ** count * (1 - p) ** (m - count)
        if short > miss:
            return count
    return m


def bits_for(n: F.Column) -> F.Column:
    return F.least(F.lit(MAX_BITS), F.greatest(F.lit(0), F.ceil(F.log2(n / F.lit(float(CELL))))))


def _directions(dim: int, n: int, stream: int) -> np.ndarray:
    return np.random.default_rng([SEED, stream, dim]).standard_normal((dim, n))


def units(column, dim: int) -> np.ndarray:
    """Unit vectors of a list column."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def places_of(x: np.ndarray) -> np.ndarray:
    """Projections of unit vectors in steps of the window, one byte each; the far ends are closed up."""
    at = np.rint(np.einsum("ij,jk->ik", x, _directions(x.shape[1], M, 2)) * (STEPS / window()))
    return np.clip(at, -127, 127).astype(np.int8)


def codes_of(x: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Cell of each vector in the first ``tables`` tables."""
    if not bits:
        return np.zeros((len(x), tables), np.int64)
    # drawn table by table, so the first tables do not depend on how many there are
    signs = np.stack([np.einsum("ij,jk->ik", x, _directions(x.shape[1], bits, 1000 + t)) > 0 for t in range(tables)], 1) if tables else \
        np.zeros((len(x), 0, bits), bool)
    return signs @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def _deal(batches):
    """Each class into its cell of every table, with its places."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            t = batch.slice(lo, 1024)
            dims, bits = t.column("dim").to_numpy(), t.column("bits").to_numpy()
            for dim, k in sorted(set(zip(dims.tolist(), bits.tolist()))):
                rows = t.take(pa.array(np.flatnonzero((dims == dim) & (bits == k))))
                x = units(rows.column("vec"), dim)
                tables = tables_for(k)
                codes = codes_of(x, k, tables)
                each = pa.array(np.repeat(np.arange(len(x)), tables))
                places = pa.array([r.tobytes() for r in places_of(x)], pa.binary())
                yield pa.record_batch(
                    [rows.column("label").take(each), rows.column("dim").take(each), rows.column("bits").take(each),
                     pa.array(np.tile(np.arange(tables, dtype=np.int32), len(x))), pa.array(codes.ravel()),
                     rows.column("rep").take(each), places.take(each)], names=["label", "dim", "bits", "tbl", "cell", "rep", "places"])


_CELL = ["label", "dim", "bits", "tbl", "cell"]
_DEALT = "label string, dim int, bits int, tbl int, cell long, rep long, places binary"


class Sorted:
    """The first projections of a block, each sorted."""

    def __init__(self, places: np.ndarray):
        places = places[:, :SORTED]
        self.order = np.argsort(places, axis=0, kind="stable").T.copy()
        self.value = np.take_along_axis(places.astype(np.int16), self.order.T, axis=0).T.copy()
        self.n = len(places)

    def counts(self, queries: np.ndarray) -> np.ndarray:
        """Collisions of each query with each row of the block: windows around the query, over all projections."""
        out = np.zeros((len(queries), self.n), np.uint8)
        q = queries.astype(np.int16)
        for j in range(SORTED):
            # one step more on either side covers the rounding of both places
            lo = np.searchsorted(self.value[j], q[:, j] - (STEPS + 1), "left")
            hi = np.searchsorted(self.value[j], q[:, j] + (STEPS + 1), "right")
            order = self.order[j]
            for r, (a, b) in enumerate(zip(lo.tolist(), hi.tolist())):
                out[r, order[a:b]] += 1
        return out


def candidates(places: np.ndarray, one: np.ndarray, two: np.ndarray | None):
    """Index pairs (block one, block two or itself) with enough collisions, some queries at a time."""
    block, least, least_of_all = Sorted(places[one if two is None else two]), required(SORTED), required(M)
    right = one if two is None else two
    for lo in range(0, len(one), QUERIES):
        q = one[lo:lo + QUERIES]
        counts = block.counts(places[q])
        i, j = np.nonzero(counts >= least)
        if two is None:
            once = q[i] < right[j]
            i, j = i[once], j[once]
        for at in range(0, len(i), 1 << 14):
            a, b = i[at:at + (1 << 14)], j[at:at + (1 << 14)]
            x, y = (places[r, SORTED:].astype(np.int16) for r in (q[a], right[b]))
            keep = counts[a, b] + (np.abs(x - y) <= STEPS + 1).sum(axis=1) >= least_of_all
            yield q[a[keep]], right[b[keep]]


def _unit_of_work(t: pa.Table):
    """(places, rows of the first block, rows of the second or None if it is the same)."""
    places = np.frombuffer(b"".join(t.column("places").to_pylist()), np.int8).reshape(-1, M)
    blk, bi, bj = (t.column(c).to_numpy() for c in ("blk", "bi", "bj"))
    return places, np.flatnonzero(blk == bi[0]), np.flatnonzero(blk == bj[0]) if bi[0] != bj[0] else None


def _mark(batches):
    """The rows of a unit of work that have a candidate in it."""
    for t in runs(batches, [*_CELL, "bi", "bj"]):
        places, one, two = _unit_of_work(t)
        has = np.zeros(t.num_rows, bool)
        for i, j in candidates(places, one, two):
            has[i] = has[j] = True
        if has.any():
            yield from t.take(pa.array(np.flatnonzero(has))).combine_chunks().to_batches()


def _link(batches):
    """Links of the candidate pairs of a unit: per class their number and the smallest class of its part."""
    for t in runs(batches, [*_CELL, "bi", "bj"]):
        places, one, two = _unit_of_work(t)
        bits, tbl = t.column("bits")[0].as_py(), t.column("tbl")[0].as_py()
        x = units(t.column("vec").combine_chunks(), t.column("dim")[0].as_py())
        earlier = codes_of(x, bits, tbl)
        left, right = [], []
        for i, j in candidates(places, one, two):
            for lo in range(0, len(i), 1 << 14):
                a, b = i[lo:lo + (1 << 14)], j[lo:lo + (1 << 14)]
                linked = np.einsum("ij,ij->i", x[a], x[b]) >= COSINE
                a, b = a[linked], b[linked]
                fresh = ~(earlier[a] == earlier[b]).any(axis=1)
                left.append(a[fresh])
                right.append(b[fresh])
        i, j = (np.concatenate(v) if v else np.zeros(0, int) for v in (left, right))
        if not len(i):
            continue
        rep, weight = t.column("rep").to_numpy(), t.column("weight").to_numpy()
        n = np.bincount(i, weights=weight[j], minlength=len(rep)) + np.bincount(j, weights=weight[i], minlength=len(rep))
        root = smallest_of_part(len(rep), i, j, rep)
        at = np.flatnonzero(n)
        yield pa.record_batch([pa.array(rep[at]), pa.array(n[at].astype(np.int64)), pa.array(root[at])], names=["rep", "links", "root"])


def link_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links, component_id, kept."""
    ship(vectors.sparkSession)
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"),
                          F.col(label_col).cast("string").alias("label"))
    finite = F.forall("vec", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))
              & F.exists("vec", lambda x: x != 0))
    rows = rows.withColumn("key", F.when(usable, F.md5(F.concat_ws(",", F.transform("vec", lambda x: x.cast("string"))))))
    largest = F.array_max(F.transform("vec", F.abs))
    classes = (rows.filter("key is not null").groupBy("label", "key")
               .agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("weight"), F.first("vec").alias("vec"))
               .withColumn("vec", F.transform("vec", lambda x: x / largest)))
    # rep: a number of its own for each class, since ids may repeat; fixed by writing it
    classes = materialize(classes.withColumn("rep", F.monotonically_increasing_id()), "vec-classes")
    sized = classes.withColumn("dim", F.size("vec"))
    per = sized.groupBy("label", "dim").agg(bits_for(F.count(F.lit(1))).cast("int").alias("bits"))
    dealt = materialize(sized.join(per, ["label", "dim"]).select("label", "dim", "bits", "rep", "vec").mapInArrow(_deal, _DEALT), "vec-cells")
    sizes = dealt.groupBy(*_CELL).agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
    unit = [*_CELL, "bi", "bj"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    split = in_blocks(dealt.join(sizes, _CELL), F.col("blocks")).select(*unit, "blk", "rep", "places")
    marked = materialize(split.repartition(n, *unit).sortWithinPartitions(*unit)
                         .mapInArrow(_mark, split.schema), "vec-candidates")
    full = marked.join(classes.select("rep", "weight", "vec"), "rep")
    found = materialize(full.repartition(n, *unit).sortWithinPartitions(*unit)
                        .select(*unit, "blk", "rep", "places", "weight", "vec").mapInArrow(_link, "rep long, links long, root long"), "vec-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), "vectors")
    of_class = (classes.select("label", "key", "rep", "first_id", "weight").join(links, "rep", "left")
                .join(groups, F.col("rep") == F.col("node"), "left")
                .select("label", "key", "first_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n"), F.coalesce("root", "rep").alias("root")))
    smallest = of_class.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = of_class.join(smallest, "root").select("label", "key", "n", "component_id")
    return (rows.select("vec_id", "label", "key").join(of_class, ["label", "key"], "left")
            .select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def op4_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"))
