"""Token-ID store: one concatenated id array with Elias-Fano document boundaries.

Texts are range-partitioned by ``doc_id`` and encoded in that order. Each task
writes segments of about ``SEGMENT_IDS`` ids. A segment is one binary value:

    magic "EFTS" | u8 version, u8 id width | u16 0 | u64 n_docs, n_ids, n_null
    Elias-Fano block of the document ids (ascending, offset by the first)
    Elias-Fano block of the n_docs + 1 id boundaries
    the ids, little-endian

    Elias-Fano block: u64 n, universe, base (i64), u8 low bits (padded to 8),
    packed low bits, unary high bits (both as little-endian u64 words)

Boundary i costs about 2 + log2(universe / n) bits; ``EliasFano.select`` finds
it from a sampled rank of the high bits, with no table of 64-bit offsets.
Segments are rows (shard, segment, n_docs, n_ids, payload) of a Parquet
dataset, so Spark's committer decides which attempt of a task counts and the
store can live on any file system that Spark writes to.

Defined cases: a null or empty text is one end id; a null ``doc_id`` sorts
first and reads back as null; repeated rows are all kept; rows with equal
``doc_id`` stand in the order of the input; an empty table gives
an empty store; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratecraft.llm.common import ship, table
from ratecraft.llm.pieces import encoder
from ratecraft.session import scratch_path

END_ID = 0
SEGMENT_IDS = 1 << 20
ROWS_OUT = 20_000
SELECT_SAMPLE = 256
MAGIC = b"EFTS"
_HEAD = struct.Struct("<4sBBHQQQ")
_EF_HEAD = struct.Struct("<QQqB7x")


class EliasFano:
    """A non-decreasing integer sequence in about 2 + log2(u/n) bits an entry."""

    def __init__(self, n: int, universe: int, base: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.universe, self.base, self.low_bits = n, universe, base, low_bits
        self.low, self.high = low, high
        self._samples = None

    @classmethod
    def encode(cls, values) -> "EliasFano":
        v = np.asarray(values, np.int64)
        n = len(v)
        if n == 0:
            return cls(0, 0, 0, 0, np.zeros(0, "<u8"), np.zeros(0, "<u8"))
        base = int(v[0])
        rel = (v - base).astype(np.uint64)
        universe = int(rel[-1]) + 1
        bits = max(0, (universe // n).bit_length() - 1)
        low_word = np.zeros((n * bits + 63) // 64 * 64, np.uint8)
        if bits:
            shifts = np.arange(bits, dtype=np.uint64)
            low_word[: n * bits] = ((rel[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel()
        at = (rel >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(at[-1]) + 64) // 64 * 64, np.uint8)
        high[at] = 1
        pack = lambda b: np.packbits(b, bitorder="little").view("<u8")
        return cls(n, universe, base, bits, pack(low_word), pack(high))

    def to_bytes(self) -> bytes:
        return (_EF_HEAD.pack(self.n, self.universe, self.base, self.low_bits)
                + struct.pack("<QQ", len(self.low), len(self.high))
                + self.low.tobytes() + self.high.tobytes())

    @classmethod
    def from_buffer(cls, buf, at: int = 0) -> tuple["EliasFano", int]:
        n, universe, base, bits = _EF_HEAD.unpack_from(buf, at)
        at += _EF_HEAD.size
        n_low, n_high = struct.unpack_from("<QQ", buf, at)
        at += 16
        low = np.frombuffer(buf, "<u8", n_low, at)
        high = np.frombuffer(buf, "<u8", n_high, at + 8 * n_low)
        return cls(n, universe, base, bits, low, high), at + 8 * (n_low + n_high)

    def _low(self, i: int) -> int:
        if not self.low_bits:
            return 0
        at = i * self.low_bits
        w, s = divmod(at, 64)
        x = int(self.low[w]) >> s
        if s + self.low_bits > 64:
            x |= int(self.low[w + 1]) << (64 - s)
        return x & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The i-th value: position of the i-th set high bit, joined with its low bits."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        if self._samples is None:
            ones = np.cumsum(np.bitwise_count(self.high))
            # word that holds every SELECT_SAMPLE-th one, and the ones before each sampled word
            words = np.searchsorted(ones, np.arange(0, self.n, SELECT_SAMPLE), side="right")
            before = np.where(words > 0, ones[words - 1], 0)
            self._samples = words.astype(np.int32), before.astype(np.int64)
        word, seen = (int(x[i // SELECT_SAMPLE]) for x in self._samples)
        while True:
            x = int(self.high[word])
            c = x.bit_count()
            if seen + c > i:
                break
            seen, word = seen + c, word + 1
        for _ in range(i - seen):
            x &= x - 1
        pos = word * 64 + (x & -x).bit_length() - 1
        return self.base + (((pos - i) << self.low_bits) | self._low(i))

    def values(self) -> np.ndarray:
        """All values at once (a segment is small)."""
        if self.n == 0:
            return np.zeros(0, np.int64)
        bits = np.unpackbits(self.high.view(np.uint8), bitorder="little")
        out = (np.flatnonzero(bits)[: self.n] - np.arange(self.n)).astype(np.int64) << self.low_bits
        if self.low_bits:
            low = np.unpackbits(self.low.view(np.uint8), bitorder="little")[: self.n * self.low_bits]
            out += low.reshape(self.n, self.low_bits).astype(np.int64) @ (np.int64(1) << np.arange(self.low_bits))
        return out + self.base


def pack_segment(doc_ids: list, lengths: list[int], ids: list[bytes], width: int) -> bytes:
    """One segment from ascending ``doc_ids`` (nulls first), id counts and id bytes."""
    nulls = sum(d is None for d in doc_ids)
    bounds = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]) if lengths else np.zeros(1, np.int64)
    return b"".join([_HEAD.pack(MAGIC, 1, width, 0, len(doc_ids), int(bounds[-1]), nulls),
                     EliasFano.encode(doc_ids[nulls:]).to_bytes(), EliasFano.encode(bounds).to_bytes(), *ids])


class Segment:
    """Reader of one segment."""

    def __init__(self, payload: bytes):
        magic, version, width, _, self.n_docs, self.n_ids, self.n_null = _HEAD.unpack_from(payload)
        if magic != MAGIC or version != 1:
            raise ValueError("not a token segment")
        self.keys, at = EliasFano.from_buffer(payload, _HEAD.size)
        self.bounds, at = EliasFano.from_buffer(payload, at)
        self.ids = np.frombuffer(payload, f"<u{width}", self.n_ids, at)

    def doc_ids(self) -> list:
        return [None] * self.n_null + self.keys.values().tolist()

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document, end id included, by two selects."""
        return self.ids[self.bounds.select(i): self.bounds.select(i + 1)]


def _write_partition(tokenizer: str | None, segment_ids: int):
    def run(batches):
        from pyspark import TaskContext
        shard = TaskContext.get().partitionId()
        enc = encoder(tokenizer)
        end = np.array([END_ID], enc.dtype).tobytes()
        docs, lengths, ids, total, segment = [], [], [], 0, 0

        def flush():
            payload = pack_segment(docs, lengths, ids, enc.width)
            return pa.record_batch(
                [pa.array([shard], pa.int32()), pa.array([segment], pa.int32()), pa.array([len(docs)], pa.int64()),
                 pa.array([total], pa.int64()), pa.array([payload], pa.binary())],
                names=["shard", "segment", "n_docs", "n_ids", "payload"])

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                data = enc.encode(text) + end
                docs.append(doc)
                ids.append(data)
                lengths.append(len(data) // enc.width)
                total += lengths[-1]
                if total >= segment_ids:
                    yield flush()
                    docs, lengths, ids, total, segment = [], [], [], 0, segment + 1
        if docs:
            yield flush()
    return run


def write_store(docs: DataFrame, path: str, tokenizer: str | None = None, shards: int | None = None,
                segment_ids: int = SEGMENT_IDS) -> None:
    """Encode ``docs`` (doc_id, text) and write the store to ``path``."""
    spark = docs.sparkSession
    ship(spark)
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (docs.select("doc_id", "text")
               .withColumn("place", F.monotonically_increasing_id())      # also deals out the rows of one id
               .repartitionByRange(n, "doc_id", "place").sortWithinPartitions("doc_id", "place")
               .select("doc_id", "text"))
    (ordered.mapInArrow(_write_partition(tokenizer, segment_ids),
                        "shard int, segment int, n_docs long, n_ids long, payload binary")
     .write.mode("overwrite").option("compression", "none").parquet(path))


def _read_rows(batches):
    schema = ["doc_id", "shard", "segment", "offset", "n_tokens", "ids_crc32"]
    for batch in batches:
        for shard, segment, payload in zip(*(batch.column(c).to_pylist() for c in ("shard", "segment", "payload"))):
            seg = Segment(payload)
            docs, bounds = seg.doc_ids(), seg.bounds.values()
            for lo in range(0, seg.n_docs, ROWS_OUT):
                hi = min(seg.n_docs, lo + ROWS_OUT)
                wide = memoryview(seg.ids[bounds[lo]:bounds[hi]].astype("<u4"))
                at = (bounds[lo:hi + 1] - bounds[lo]).tolist()
                crc = [zlib.crc32(wide[a:b]) for a, b in zip(at[:-1], at[1:])]
                yield pa.record_batch(
                    [pa.array(docs[lo:hi], pa.int64()), pa.array([shard] * (hi - lo), pa.int32()),
                     pa.array([segment] * (hi - lo), pa.int32()), pa.array(bounds[lo:hi], pa.int64()),
                     pa.array(np.diff(bounds[lo:hi + 1]), pa.int64()), pa.array(crc, pa.int64())], names=schema)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document from the store's files: doc_id, start, n_tokens, ids_crc32, shard, segment.

    ``start`` = ids in earlier shards + ids in earlier segments of the shard
    + the offset inside the segment. Only the per-shard totals (one row a
    shard) meet in one task.
    """
    ship(spark)
    store = spark.read.parquet(path)
    sizes = store.select("shard", "segment", "n_ids")
    per_shard = sizes.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shard_base = per_shard.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("shard_base"))
    inside = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    base = (sizes.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
            .join(shard_base, "shard")
            .select("shard", "segment", (F.col("shard_base") + F.col("inside")).alias("base")))
    rows = store.select("shard", "segment", "payload").mapInArrow(
        _read_rows, "doc_id long, shard int, segment int, offset long, n_tokens long, ids_crc32 long")
    return (rows.join(base, ["shard", "segment"])
            .select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32",
                    "shard", "segment"))


def token_store(docs: DataFrame, path: str | None = None, tokenizer: str | None = None) -> DataFrame:
    """Write the store of ``docs`` and return the index read back from its files."""
    path = path or scratch_path(docs.sparkSession, "token-store")
    write_store(docs, path, tokenizer)
    return read_index(docs.sparkSession, path)


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store(table(spark, sf_dir, "documents"))
