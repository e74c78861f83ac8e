"""Benchmark decontamination with one Aho-Corasick automaton over normalised items.

Texts and items are normalised alike: A-Z lower-cased, words taken as runs of
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` and joined by single spaces. Every
window of ``window`` consecutive item words (an item of fewer words is one
window) is one pattern of the automaton, which scans each normalised text
once. Hits are turned into word ranges, and word ranges into character spans
of the original text.

The item patterns reach the workers as a broadcast of checked size. An
automaton has about ``window`` nodes for each byte of its items and a node takes
some 46 bytes, so the summed item bytes are measured first, and a benchmark
beyond ``MAX_NODES`` (about 0.6 GB a worker) is dealt into parts by a hash of
the item, each scanned in a pass of its own that adds to the same columns: one
pass over the documents for every 1.2 MB of items.

Defined cases: a null or empty text has no words and no hits; a null or empty
item has no windows; repeated item rows count once; an item without an id
marks words but is not listed; repeated documents are scanned each by itself;
other columns stay as they are.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecraft.llm.common import aside, ship, table
from ratecraft.session import materialize

WINDOW = 10
MAX_NODES = 12_000_000       # of an automaton
#: Bytes outside digits, letters and 0x80-0xFF read as a space, A-Z as a-z.
_FOLD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A
              else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

HITS = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("after", T.LongType())]))


def words_of(text: str | None) -> list[bytes]:
    """Normalised words of a text, as UTF-8 bytes."""
    return text.encode().translate(_FOLD).split() if text else []


def original_spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character spans [start, end) in ``text`` of word ranges [first, after)."""
    at = [m.span() for m in _WORD.finditer(text)]
    return [(at[a][0], at[b - 1][1]) for a, b in ranges]


def item_patterns(items: list[tuple[str | None, str | None]], window: int) -> dict[str, set[str | None]]:
    """Pattern (words with a space around them, one character a byte) -> ids of its items."""
    out: dict[str, set] = {}
    for item, text in items:
        words = words_of(text)
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            key = (b" " + b" ".join(words[i:i + n]) + b" ").decode("latin-1")
            out.setdefault(key, set()).add(item)
    return out


def merge_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


class Scanner:
    """The automaton and its use on one text."""

    def __init__(self, items, window: int = WINDOW):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        for key, ids in item_patterns(items, window).items():
            self.automaton.add_word(key, (len(key), key.count(" ") - 1, tuple(ids)))
        if len(self.automaton):
            self.automaton.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], set]:
        """(number of words, merged hit word ranges, ids of the items that occur)."""
        words = words_of(text)
        if not words or not len(self.automaton):
            return len(words), [], set()
        line = (b" " + b" ".join(words) + b" ").decode("latin-1")
        ranges, ids, starts = [], set(), None
        for end, (size, n, found) in self.automaton.iter(line):
            if starts is None:  # offset of the space before each word
                starts = np.cumsum([0] + [len(w) + 1 for w in words])
            first = int(np.searchsorted(starts, end - size + 1))
            ids.update(found)
            ranges.append((first, first + n))
        return len(words), merge_ranges(ranges), ids


_SCANNERS: dict = {}


def _scan_pass(shared, tag: str, window: int, first_pass: bool):
    def run(batches):
        key = (tag, window)
        if key not in _SCANNERS:
            _SCANNERS.clear()
            _SCANNERS[key] = Scanner(shared.value, window)
        scanner = _SCANNERS[key]
        for batch in batches:
            n, hits, ids = [], [], []
            for text in batch.column("text").to_pylist():
                a, b, c = scanner.scan(text)
                n.append(a)
                hits.append([{"first": x, "after": y} for x, y in b])
                ids.append(sorted(x for x in c if x is not None))
            if first_pass:
                new = [pa.array(n, pa.int64()), pa.array(hits, pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())]))),
                       pa.array(ids, pa.list_(pa.string()))]
                yield pa.record_batch([*batch.columns, *new], names=[*batch.schema.names, "n_words", "hits", "items"])
            else:
                names = batch.schema.names
                cols = list(batch.columns)
                old = batch.column("hits").to_pylist()
                cols[names.index("hits")] = pa.array([x + y for x, y in zip(old, hits)], cols[names.index("hits")].type)
                old = batch.column("items").to_pylist()
                cols[names.index("items")] = pa.array([sorted({*x, *y}) for x, y in zip(old, ids)], pa.list_(pa.string()))
                yield pa.record_batch(cols, names=names)
    return run


def scan_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                   max_nodes: int = MAX_NODES) -> DataFrame:
    """``docs`` (any columns, ``text`` among them) with n_words, hits, items.

    ``hits`` are word ranges [first, after) and ``items`` the sorted ids (as
    text) of items with a window that occurs. Columns of those names are
    replaced.
    """
    spark = docs.sparkSession
    ship(spark)
    items = (benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
             .filter("text is not null").distinct())
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + F.lit(16)), F.lit(0))).first()[0]
    parts = max(1, -(-int(total) * window // max_nodes))
    out = docs.drop("n_words", "hits", "items")
    for k in range(parts):
        own = items.filter(F.pmod(F.xxhash64("text"), F.lit(parts)) == k) if parts > 1 else items
        shared = spark.sparkContext.broadcast([(r.item_id, r.text) for r in own.collect()])
        schema = out.schema
        if k == 0:
            schema = T.StructType([*schema.fields, T.StructField("n_words", T.LongType()), T.StructField("hits", HITS),
                                   T.StructField("items", T.ArrayType(T.StringType()))])
        elif k > 0:
            out = materialize(out, "decontam-pass")
        out = out.mapInArrow(_scan_pass(shared, uuid.uuid4().hex, window, k == 0), schema)
    return out


def with_spans(scanned: DataFrame) -> DataFrame:
    """Add ``spans``: character spans of the original text that hold hits."""
    def run(batches):
        for batch in batches:
            spans = []
            for text, hits in zip(batch.column("text").to_pylist(), batch.column("hits").to_pylist()):
                ranges = merge_ranges([(h["first"], h["after"]) for h in hits])
                spans.append([{"start": a, "end": b} for a, b in original_spans(text, ranges)] if ranges else [])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.record_batch([*batch.columns, pa.array(spans, kind)], names=[*batch.schema.names, "spans"])
    field = T.StructField("spans", T.ArrayType(T.StructType(
        [T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))
    return scanned.drop("spans").mapInArrow(run, T.StructType([*scanned.drop("spans").schema.fields, field]))


def hit_words() -> F.Column:
    """Words covered by ``hits``: the ranges of one pass never overlap, those of several may."""
    merged = F.aggregate(
        F.array_sort("hits"), F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("upto")),
        lambda acc, h: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("long"), h["after"] - F.greatest(h["first"], acc["upto"]))).alias("n"),
            F.greatest(acc["upto"], h["after"]).alias("upto")),
        lambda acc: acc["n"])
    return merged


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Rows of ``docs``, all their columns as they are, in which no window of the benchmark occurs."""
    rows, back = aside(docs, "text")
    return back(scan_documents(rows, benchmark, **options).filter(F.size("hits") == 0))


def op7_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return scanned.select(
        "doc_id", "n_words", hit_words().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))
