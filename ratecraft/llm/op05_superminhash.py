"""SuperMinHash near-duplicate groups of documents, confirmed on full shingle sets.

1. Each text becomes its set of distinct shingles of ``size`` words (``SHINGLE``
   in the query, five in the corpus pipeline), as 64-bit hashes (a text with
   fewer words is one shingle). Per document a SuperMinHash
   signature of ``M`` values is built: element x offers value j + r_j(x) at
   place p_j(x), for the steps j = 0, 1, ... of a random permutation of the
   places, and steps stop as soon as no place could still be lowered. Every
   element hits all places once, which lowers the variance against
   independent hashes; a text with many shingles needs one step.
2. Documents with equal sets are one class, shown by its smallest id; copies
   are never paired with each other.
3. ``M`` = ``BANDS`` x ``ROWS``. Classes that agree in a band share a bucket. A
   pair at similarity s shares one with probability 1 - (1 - s^ROWS)^BANDS; at
   0.8 all but 5 in 10^8 do.
4. Families: each member of a bucket is compared with the bucket's smallest
   class by signature, and pairs within ``SLACK`` of the limit are joined by
   union-find. Buckets that then hold several families are dealt into blocks
   whose block pairs compare signatures across families. Every pair that shares
   a bucket and may reach the limit so ends up in one family, and a bucket of n
   copies gives n edges, not n^2.
5. Links: the texts of the families alone are shingled again. Families are
   dealt into blocks bounded in documents and in shingles, and a block pair
   counts all its intersections exactly, from the shingles that two of its
   documents hold. It returns a spanning forest of the links that reach the
   limit, never the pairs; union-find joins these to the groups. No bucket or
   family is capped.

Defined cases: null, empty and white-space-only texts have no shingles and
link with nothing; a null id takes part in no group (component_id null, kept
true); rows that share an id are one document; repeated rows are returned as
often as given; an empty table gives an empty result; other columns are
ignored or passed through.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.llm.common import U64, components, mix64, ship, table, text_parts, utf8_buffer
from ratecraft.session import materialize

SHINGLE = 2              # words of a shingle, unless a caller says otherwise
SIMILARITY = 80          # per cent
BANDS, ROWS = 32, 4
M = BANDS * ROWS
SLACK = 0.16             # 4.5 standard deviations of the estimate at 0.8
BLOCK = 512              # classes of a bucket compared together by signature
SET_BLOCK = 256          # documents of a family compared together exactly
SET_SHINGLES = 200_000   # and their shingles
COLUMNS = 8192
PIECE = 4 << 20
SLICE = 1 << 20          # bytes of the texts that are shingled together
_SEP = np.zeros(256, bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * U64(0xD1B54A32D192ED03))
_BYTE[65:91] = _BYTE[97:123]                      # A-Z as a-z
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64, n of each at least."""
    if not _POWERS or len(_POWERS[0]) < n:
        n = 1 << max(n - 1, 1 << 16).bit_length()
        with np.errstate(over="ignore"):
            for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
                p = np.full(n, base, U64)
                p[0] = 1
                _POWERS[k:k + 1] = [np.multiply.accumulate(p)]
    return _POWERS[0], _POWERS[1]


def _piece_hashes(raw: np.ndarray, doc_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every word of a byte buffer that holds several texts."""
    n = len(raw)
    if n == 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    word = ~_SEP[raw]
    first = np.zeros(n + 1, bool)
    first[doc_starts] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | first[1:n]
    stop = word.copy()
    stop[:-1] &= ~word[1:] | first[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(stop) + 1
    up, down = _powers(n)
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, U64)
        np.cumsum(_BYTE[raw] * up[:n], out=total[1:])
        h = mix64((total[e] - total[s]) * down[s] + (e - s).astype(U64))
    return h, np.searchsorted(doc_starts, s, side="right") - 1


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and documents of texts; a text longer than ``PIECE`` bytes is read in pieces."""
    if len(raw) <= PIECE or len(offsets) > 2:
        return _piece_hashes(raw, offsets[:-1])
    out, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + PIECE)
        if end < len(raw):                        # cut after white space, else read on to the next
            gap = np.flatnonzero(_SEP[raw[at:end]])
            if len(gap) == 0:
                gap = np.flatnonzero(_SEP[raw[end:]])
                end = end + int(gap[0]) + 1 if len(gap) else len(raw)
            else:
                end = at + int(gap[-1]) + 1
        out.append(_piece_hashes(raw[at:end], np.zeros(1, np.int64))[0])
        at = end
    h = np.concatenate(out)
    return h, np.zeros(len(h), np.int64)


def shingles(raw: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and their starts (texts + 1)."""
    n_docs = len(offsets) - 1
    h, doc = word_hashes(raw, offsets)
    counts = np.bincount(doc, minlength=n_docs)
    with np.errstate(over="ignore"):
        def joined(length):
            x = np.zeros(max(len(h) - length + 1, 0), U64)
            for k in range(length):
                x = mix64(x * U64(0x9FB21C651E98DF25) + h[k:k + len(x)])
            return x + U64(length)

        x = mix64(joined(size))
        own = doc[:len(x)] == doc[size - 1:]
        value, of = x[own], doc[:len(x)][own]
        starts = np.concatenate([[0], np.cumsum(counts)])
        for length in range(1, size):             # whole sequence of the shorter texts
            short = np.flatnonzero(counts == length)
            if len(short):
                value = np.concatenate([value, mix64(joined(length))[starts[short]]])
                of = np.concatenate([of, short])
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    keep = np.ones(len(value), bool)
    keep[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    value, of = value[keep], of[keep]
    return value, np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n_docs))]).astype(np.int64)


def superminhash(x: np.ndarray, m: int = M) -> np.ndarray:
    """SuperMinHash values of a non-empty set: (step << 48) | 48 random bits at each place."""
    h = np.full(m, np.iinfo(np.uint64).max, U64)
    rows, perm, first = np.arange(len(x)), None, None
    for j in range(m):
        with np.errstate(over="ignore"):
            r = mix64(x + U64(0x632BE59BD9B4E019) * U64(j + 1))
            k = j + (((r >> U64(40)) * U64(m - j)) >> U64(24)).astype(np.int64)
        if j == 0:
            place = first = k
        else:
            if perm is None:                      # permutations are kept only if a first step was not enough
                perm = np.tile(np.arange(m, dtype=np.int16), (len(x), 1))
                perm[rows, first] = 0
            place = perm[rows, k]
            perm[rows, k] = perm[:, j]
        np.minimum.at(h, place, (U64(j) << U64(48)) | (mix64(r) >> U64(16)))
        if int(h.max()) >> 48 <= j:               # no later step can lower any place
            break
    return h


def band_keys(h: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of a signature."""
    v = h.reshape(BANDS, ROWS)
    with np.errstate(over="ignore"):
        key = np.arange(1, BANDS + 1, dtype=np.uint64) * U64(0xA0761D6478BD642F)
        for k in range(ROWS):
            key = mix64(key ^ v[:, k]) + U64(k)
    return key


_SIGNED = ("doc_id long, n_shingles long, k1 long, k2 long, bands array<long>, sig binary")


def _sign(size: int):
    """Signatures of texts whose shingles have ``size`` words."""
    def run(batches):
        names = ["doc_id", "n_shingles", "k1", "k2", "bands", "sig"]
        for batch in batches:
            for part in text_parts(batch, max_bytes=SLICE):
                raw, offsets = utf8_buffer(part.column("text"))
                value, starts = shingles(raw, offsets, size)
                n = np.diff(starts)
                with np.errstate(over="ignore"):
                    sums = [np.concatenate([np.zeros(1, U64), np.cumsum(mix64(value ^ U64(c)))]) for c in (0x5851F42D, 0x14057B7E)]
                k1, k2 = ((t[starts[1:]] - t[starts[:-1]]).view(np.int64) for t in sums)
                bands, sig = [], []
                for a, b in zip(starts[:-1], starts[1:]):
                    if a == b:
                        bands.append(None)
                        sig.append(None)
                        continue
                    h = superminhash(value[a:b])
                    bands.append(band_keys(h).view(np.int64))
                    sig.append(mix64(h).astype("<u2").tobytes())
                yield pa.record_batch([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(k1), pa.array(k2),
                                       pa.array(bands, pa.list_(pa.int64())), pa.array(sig, pa.binary())], names=names)
    return run


def _sets(size: int):
    """Shingle sets of texts; rows of one id come together, and one that repeats an earlier set of its id is left out."""
    def run(batches):
        last, seen = None, set()
        for batch in batches:
            for part in text_parts(batch, max_bytes=SLICE):
                raw, offsets = utf8_buffer(part.column("text"))
                value, starts = shingles(raw, offsets, size)
                keep = []
                for i, rep in enumerate(part.column("doc_id").to_pylist()):
                    if rep != last:
                        last, seen = rep, set()
                    digest = hashlib.blake2b(value[starts[i]:starts[i + 1]].tobytes(), digest_size=16).digest()
                    if digest not in seen:
                        seen.add(digest)
                        keep.append(i)
                sets = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(value.view(np.int64)))
                out = pa.record_batch([part.column("doc_id"), part.column("family"), part.column("size"), sets],
                                      names=["rep", "family", "size", "set"])
                yield out if len(keep) == out.num_rows else out.take(pa.array(keep, pa.int64()))
    return run


def _near(limit: float):
    """Keep pairs whose signatures agree in at least ``limit`` of their places."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, M) for c in ("sig_a", "sig_b"))
                keep = np.flatnonzero((a == b).mean(axis=1) >= limit)
                yield batch.select(["a", "b"]).take(pa.array(keep))
    return run


def runs(batches, keys: list[str]):
    """Tables of the runs of equal ``keys`` in sorted batches, whole across batch borders."""
    rest = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([rest, t]) if rest is not None else t
        if t.num_rows == 0:
            continue
        change = np.zeros(t.num_rows - 1, bool)
        for k in keys:
            v = t.column(k).to_numpy()
            change |= v[1:] != v[:-1]
        cuts = np.concatenate([[0], np.flatnonzero(change) + 1])
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield t.slice(a, b - a)
        rest = t.slice(cuts[-1])
    if rest is not None and rest.num_rows:
        yield rest


def _cross_pairs(limit: float):
    """Within block pairs of buckets: edges that span what may be linked across families."""
    def run(batches):
        for t in runs(batches, ["key", "bi", "bj"]):
            blk, bi, bj = (t.column(c).to_numpy() for c in ("blk", "bi", "bj"))
            rep, g, n = (t.column(c).to_numpy() for c in ("rep", "g", "n"))
            sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), "<u2").reshape(-1, M)
            left = np.flatnonzero(blk == bi[0])
            right = left if bi[0] == bj[0] else np.flatnonzero(blk == bj[0])
            family = np.unique(g, return_inverse=True)[1]
            edges = []
            for i in left:
                others = right[right > i] if right is left else right
                others = others[(family[others] != family[i]) & (100 * np.minimum(n[others], n[i]) >= SIMILARITY * np.maximum(n[others], n[i]))]
                if len(others):
                    others = others[(sig[others] == sig[i]).mean(axis=1) >= limit]
                    joined, at = np.unique(family[others], return_index=True)
                    edges += [(rep[i], rep[k]) for k in others[at]]
                    family[np.isin(family, joined)] = family[i]
            if edges:
                a, b = np.array(edges, np.int64).T
                yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])
    return run


def smallest_of_part(n: int, i: np.ndarray, j: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Smallest ``value`` of each node's connected part (edges i-j), by label passing."""
    low = value.copy()
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        if np.array_equal(new, low):
            return low
        low = new


def common_counts(values: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets at ``left`` with those at ``right``."""
    size = np.array([len(v) for v in values])
    row = np.repeat(np.arange(len(values)), size)
    _, column, count = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
    shared = count > 1                            # a shingle of one set alone is in no intersection
    number = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], number[column[keep]]
    out = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for lo in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(column, [lo, lo + COLUMNS])
        part = np.zeros((len(values), COLUMNS), np.float32)
        part[row[a:b], column[a:b] - lo] = 1
        out += part[left] @ part[right].T
    return out.astype(np.int64)


def _exact_links(batches):
    """Within block pairs of families: a spanning forest of the confirmed links."""
    for t in runs(batches, ["family", "bi", "bj"]):
        blk, bi, bj = (t.column(c).to_numpy() for c in ("blk", "bi", "bj"))
        rep = t.column("rep").to_numpy()
        sets = t.column("set").combine_chunks()
        flat, starts = sets.values.to_numpy(), sets.offsets.to_numpy()
        values = [flat[a:b] for a, b in zip(starts[:-1], starts[1:])]
        left, right = np.flatnonzero(blk == bi[0]), np.flatnonzero(blk == bj[0])
        if not len(left) or not len(right) or t.num_rows < 2:
            continue
        n = np.array([len(v) for v in values], np.int64)
        common = common_counts(values, left, right)
        linked = 100 * common >= SIMILARITY * (n[left][:, None] + n[right][None, :] - common)
        i, j = np.nonzero(linked)
        root = smallest_of_part(t.num_rows, left[i], right[j], rep)
        at = np.flatnonzero(root != rep)
        if len(at):
            yield pa.record_batch([pa.array(rep[at]), pa.array(root[at])], names=["a", "b"])


def signatures(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, set digest (k1, k2), band keys and 16-bit signature of each document."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_sign(size), _SIGNED)


def _families(classes: DataFrame) -> DataFrame:
    """(node, root) of the families of ``classes``: a superset of the links, by bands and signatures."""
    limit = SIMILARITY / 100 - SLACK
    rows = classes.select(F.explode("bands").alias("key"), "rep", F.col("n_shingles").alias("n"))
    pivots = (rows.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("p"), F.count(F.lit(1)).alias("size"))
              .filter("size > 1"))
    fits = 100 * F.least("n", "p.n") >= SIMILARITY * F.greatest("n", "p.n")
    pairs = (rows.join(pivots, "key").filter("rep != p.rep").filter(fits)
             .select(F.col("p.rep").alias("a"), F.col("rep").alias("b")).distinct())
    sig = classes.select("rep", "sig")
    near = (pairs.join(sig.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b")), "b")
            .join(sig.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a")), "a")
            .select("a", "b", "sig_a", "sig_b").mapInArrow(_near(limit), "a long, b long"))
    near = materialize(near.distinct(), "minhash-near")
    groups = components(near, "minhash-near")

    member = (rows.join(pivots.select("key", F.col("p.rep").alias("pivot"), "size").filter("size > 2"), "key")
              .filter("rep != pivot")
              .join(groups, F.col("rep") == F.col("node"), "left")
              .select("key", "rep", "n", "size", F.coalesce("root", "rep").alias("g")))
    mixed = member.groupBy("key").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).filter("lo < hi").select("key")
    member = in_blocks(member.join(mixed, "key").join(sig, "rep"), F.ceil(F.col("size") / F.lit(BLOCK)))
    dealt = (member.select("key", "bi", "bj", "blk", "rep", "g", "n", "sig")
             .repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj"))
    more = dealt.mapInArrow(_cross_pairs(limit), "a long, b long").distinct()
    return components(near.union(more), "minhash-families")


def in_blocks(rows: DataFrame, blocks: F.Column) -> DataFrame:
    """Each row once for every pair (bi, bj) of blocks that its own block ``blk`` is part of."""
    return (rows.withColumn("blocks", blocks.cast("int"))
            .withColumn("blk", F.pmod(F.xxhash64("rep"), F.col("blocks").cast("long")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("bi", F.least("blk", "other")).withColumn("bj", F.greatest("blk", "other")))


def _links(docs: DataFrame, classes: DataFrame, families: DataFrame, shingle: int) -> DataFrame:
    """Edges (a, b) that span the links of the families, confirmed on full sets."""
    member = classes.select("rep", F.col("n_shingles").alias("n"))
    root = families.select("root").distinct().select(F.col("root").alias("node"), "root")
    member = member.join(families.unionByName(root), F.col("rep") == F.col("node")).select("rep", "n", F.col("root").alias("family"))
    size = member.groupBy("family").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(SET_BLOCK)), F.ceil(F.sum("n") / F.lit(SET_SHINGLES))).alias("size"))
    member = materialize(member.join(size, "family").select("rep", "family", "size").distinct(), "minhash-members")
    # by shuffle at every size: a plan that changes with the number of members would change what is moved
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
             .join(member.hint("merge"), F.col("doc_id") == F.col("rep")).select("doc_id", "text", "family", "size"))
    sets = in_blocks(texts.mapInArrow(_sets(shingle), "rep long, family long, size long, set array<long>"), F.col("size"))
    dealt = (sets.select("family", "bi", "bj", "blk", "rep", "set")
             .repartition("family", "bi", "bj").sortWithinPartitions("family", "bi", "bj"))
    return dealt.mapInArrow(_exact_links, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept; shingles of ``size`` words."""
    signed = materialize(signatures(docs, size), "minhash-signed")
    classes = materialize(
        signed.filter("n_shingles > 0 and doc_id is not null").groupBy("k1", "k2", "n_shingles")
        .agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("sig").alias("sig")), "minhash-classes")
    groups = components(_links(docs, classes, _families(classes), size), "minhash")
    of_class = (classes.select("k1", "k2", F.col("n_shingles").alias("n"), "rep")
                .join(groups, F.col("rep") == F.col("node"), "left")
                .select("k1", "k2", "n", F.coalesce("root", "rep").alias("root")))
    same = [signed[c] == of_class[c] for c in ("k1", "k2")] + [signed["n_shingles"] == of_class["n"]]
    return (signed.select("doc_id", "n_shingles", "k1", "k2").join(of_class, same, "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def drop_duplicates(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``docs`` with one document of each group (the smallest id, one row of it); rows without an id stay."""
    kept = near_duplicates(docs, size).filter("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.filter("doc_id is null")).select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), SHINGLE)
