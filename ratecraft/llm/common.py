"""Small shared pieces: table loading, Arrow text access, hashing, components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.session import materialize

U64 = np.uint64


#: Per application the folder of its code zip, removed when this process ends.
_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once a session, as a zip that Spark hands out."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parents[1]
    folder = tempfile.TemporaryDirectory(prefix="ratecraft-code-", ignore_cleanup_errors=True)
    path = os.path.join(folder.name, f"{top.name}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(path)
    _SHIPPED[sc.applicationId] = folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def aside(docs: DataFrame, *needed: str):
    """(``docs`` with every column but ``needed`` under a name of its own, a function that gives a frame the columns back).

    Operators that filter or repeat rows work on such a frame, so no column of
    the input can clash with those that they add.
    """
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    names = {c: c if c in needed else f"__in_{i}" for i, c in enumerate(docs.columns)}
    return (docs.select(*[quoted(c).alias(n) for c, n in names.items()]),
            lambda out: out.select(*[F.col(n).alias(c) for c, n in names.items()]))


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser over an unsigned 64-bit array (wraps by design)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U64(30))
        x = x * U64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> U64(27))
        x = x * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def text_parts(batch: pa.RecordBatch, name: str = "text", max_bytes: int = 4 << 20):
    """Yield slices of an Arrow batch whose texts sum to about ``max_bytes``.

    A single longer text forms a slice of its own, so the memory of a caller
    that works slice by slice follows the longest text, not the batch.
    """
    i = batch.schema.get_field_index(name)
    size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(i)), 0), dtype=np.int64)
    start, used = 0, 0
    for k, n in enumerate(size):
        if k > start and used + n > max_bytes:
            yield batch.slice(start, k - start)
            start, used = k, 0
        used += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


def utf8_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column as numpy arrays; null reads as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pa.compute.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64, len(column) + 1, column.offset * 8)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
    return raw, offsets - offsets[0]


def _union_partition(batches):
    """Union-find over the edges of one partition: (node, smallest node of its set)."""
    parent: dict[int, int] = {}

    def find(x):
        root = x
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(x, x) != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ra, rb = find(a), find(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
    nodes = [x for x in list(parent) if find(x) != x]
    for i in range(0, len(nodes), 50_000):
        part = nodes[i:i + 50_000]
        yield pa.record_batch([pa.array(part, pa.int64()), pa.array([find(x) for x in part], pa.int64())],
                              names=["u", "v"])


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``edges`` (a long, b long): rows (node, root).

    Every node that differs from the smallest node of its component gets one
    row; a smallest node (and a node without edges) gets none. Each partition
    first runs union-find on the edges it holds, then large-star and
    small-star steps (joins and min-aggregates) link the partial trees until
    each node points at its root. Each round is written to the shared folder,
    so a lost executor costs one round at most and no link reaches the driver.
    """
    ship(edges.sparkSession)
    e = edges.select(F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("v")) \
        .filter("u != v")
    e = materialize(e.mapInArrow(_union_partition, "u long, v long").distinct(), f"cc-{name}")
    while not _is_star_forest(e):
        sym = e.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        low = sym.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (sym.join(low, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.inline(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))).filter("u != v")
        e = materialize(small.mapInArrow(_union_partition, "u long, v long").distinct(), f"cc-{name}")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _is_star_forest(e: DataFrame) -> bool:
    """True if no node has two parents and no parent has a parent."""
    ends = e.select(F.inline(F.array(F.struct(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                     F.struct(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))))
    bad = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")) \
        .filter("up > 1 or (up > 0 and down > 0)")
    return bad.isEmpty()
