"""Train/test splits and folds that keep every test user and item known.

The guard (a test row stays in test only if its item and user also occur in
the training rows; otherwise it goes back to train) is computed with
aggregates, not per-fold semi/anti joins: the smallest and largest fold of a
key's rows tell for every fold whether the key has rows outside that fold. It
is a partial (map-side combined) aggregate, so a hot key costs one row per
task before the shuffle. One flag per row then yields train, test and the rows
put back, from a single pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.operators.joins import keyed_join
from ratecraft.session import materialize

KEEP = "__keep"


def hash_bucket(cols: Sequence[str], n: int, seed: int = 0) -> Column:
    """Deterministic bucket 0..n-1 from a hash of ``cols`` (partitioning independent)."""
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in cols]), F.lit(n))


def with_fold(df: DataFrame, k: int, cols: Sequence[str], seed: int = 0, name: str = "fold") -> DataFrame:
    """Add a fold column 0..k-1 (stands in for seeded random folds)."""
    return df.withColumn(name, hash_bucket(cols, k, seed))


def stratum_rank(df: DataFrame, strata: str, draw: str, slices: int = 4096) -> DataFrame:
    """Add ``rank`` (1..size, by ``draw``) and ``size`` of each row within its stratum.

    No stratum is ordered in one task: draws (evenly spread numbers of 52
    bits) are cut into ``slices`` ranges, the ranges' counts are summed up per
    stratum, and only the rows of one range are ranked together. Equal draws
    are ranked by the row's other columns.
    """
    part = F.shiftright(F.col(draw), 52 - (slices.bit_length() - 1))
    cut = df.withColumn("__part", part)
    counts = cut.groupBy(strata, "__part").agg(F.count(F.lit(1)).alias("__n"))
    upto = Window.partitionBy(strata).orderBy("__part")
    counts = counts.withColumns({
        "__before": F.sum("__n").over(upto.rowsBetween(Window.unboundedPreceding, -1)),
        "size": F.sum("__n").over(Window.partitionBy(strata))}).drop("__n")
    out = keyed_join(cut, counts, [strata, "__part"], "left", null_safe=[strata])
    inside = Window.partitionBy(strata, "__part").orderBy(draw, *[c for c in df.columns if c not in (draw, strata)])
    return (out.withColumn("rank", F.coalesce("__before", F.lit(0)) + F.row_number().over(inside))
            .select(*df.columns, "rank", "size"))


def stratified_sample(df: DataFrame, strata: str, fraction: float, draw: str, name: str = "is_test") -> DataFrame:
    """Flag ``ceil(fraction * size)`` rows of every stratum, those with the smallest ``draw``."""
    return (stratum_rank(df, strata, draw)
            .withColumn(name, F.col("rank") <= F.ceil(F.col("size") * F.lit(float(fraction)))).drop("rank", "size"))


def stratified_folds(df: DataFrame, strata: str, k: int, draw: str, name: str = "fold") -> DataFrame:
    """Fold 0..k-1 of each row; the folds of a stratum differ by one row at most."""
    return (stratum_rank(df, strata, draw)
            .withColumn(name, F.floor((F.col("rank") - 1) * k / F.col("size")).cast("int")).drop("rank", "size"))


def flag_fold_guard(df: DataFrame, fold: Column | str, k: int,
                    keys: Iterable[str] = ("item_id", "user_id"), among: Column | None = None) -> DataFrame:
    """Add ``__keep``: the row is a test row of its own fold and passes the guard.

    With ``among`` only the rows for which it holds count as known rows.

    ``fold`` outside 0..k-1 (or null) means the row is never a test row.
    A key is known for fold f when it has at least one row outside fold f, so
    it is unknown only if all its rows lie in f. One aggregate per key, straight
    on ``df``, finds the keys whose rows lie in a single fold; they are written
    and joined to the rows (few keys as a rule: then the planner broadcasts
    them and no row is moved). Null keys match each other.
    """
    fold_c = F.col(fold) if isinstance(fold, str) else fold
    out = df.withColumn("__fold", F.when((fold_c >= 0) & (fold_c < k), fold_c.cast("int")))
    known = F.lit(True) if among is None else F.coalesce(among, F.lit(False))
    keys = list(keys)
    own = F.when(known, F.col("__fold"))
    lone = []
    for i, key in enumerate(keys):
        per = out.groupBy(key).agg(F.min(own).alias("__lo"), F.max(own).alias("__hi"), F.max(known & F.col("__fold").isNull()).alias("__free"))
        only = per.filter(~F.col("__free") & (F.col("__lo").isNull() | (F.col("__lo") == F.col("__hi"))))
        lone.append(materialize(only.select(key, F.col("__lo").alias(f"__only{i}"), F.lit(True).alias(f"__lone{i}")), "guard-lone"))
    keep = F.col("__fold").isNotNull()
    for i, (key, only) in enumerate(zip(keys, lone)):
        out = keyed_join(out, only, [key], "left", null_safe=[key])
        # without a known row at all (null) a key is unknown for every fold
        keep = keep & ~(F.col(f"__lone{i}").isNotNull() & F.coalesce(F.col(f"__only{i}") == F.col("__fold"), F.lit(True)))
    return out.withColumn(KEEP, keep).drop(*[c for i in range(len(keys)) for c in (f"__only{i}", f"__lone{i}")])


def guarded_split(df: DataFrame, test_cond: Column,
                  keys: Iterable[str] = ("item_id", "user_id"),
                  persist: bool = True) -> tuple[DataFrame, DataFrame]:
    """Split into (train, test); test rows with unseen keys go back to train.

    With ``persist`` the flagged rows are written once to the shared
    checkpoint folder, so train and test (and everything built on them)
    scan that table instead of recomputing the input and the guard.
    """
    flagged = flag_fold_guard(df, F.when(F.coalesce(test_cond, F.lit(False)), F.lit(0)), 1, keys)
    if persist:
        flagged = materialize(flagged.select(*df.columns, KEEP), "guarded", rebalance=True)
    cols = df.columns
    return (flagged.filter(~F.col(KEEP)).select(*cols),
            flagged.filter(F.col(KEEP)).select(*cols))


def guard_removed(df: DataFrame, test_cond: Column,
                  keys: Iterable[str] = ("item_id", "user_id")) -> DataFrame:
    """Rows drawn for test but put back into train by the guard."""
    flagged = flag_fold_guard(df, F.when(F.coalesce(test_cond, F.lit(False)), F.lit(0)), 1, keys)
    return flagged.filter(F.col("__fold").isNotNull() & ~F.col(KEEP)).select(*df.columns)


def expand_folds(df: DataFrame, fold: Column | str, k: int,
                 keys: Iterable[str] = ("item_id", "user_id"), h: str = "h",
                 persist: bool = True) -> tuple[DataFrame, DataFrame]:
    """All k guarded folds at once, keyed by ``h``.

    Returns (train, test): test holds each kept row once, under its own fold;
    train holds each row once per fold it trains (k copies, minus the fold
    where it is a kept test row). Every later aggregate and join adds ``h``
    to its key, so all folds are fitted in the same jobs.
    """
    flagged = flag_fold_guard(df, fold, k, keys)
    cols = df.columns
    hs = F.filter(F.sequence(F.lit(0), F.lit(k - 1)),
                  lambda x: ~(F.col(KEEP) & (x == F.col("__fold"))))
    if not persist:
        return (flagged.select(F.explode(hs).alias(h), *cols),
                flagged.filter(F.col(KEEP)).select(F.col("__fold").alias(h), *cols))
    flagged = materialize(flagged.select(*cols, "__fold", KEEP), "folds", rebalance=True)
    test = flagged.filter(F.col(KEEP)).select(F.col("__fold").alias(h), *cols)
    # the copies are made in flight, inside the scans that use them
    return flagged.select(F.explode(hs).alias(h), *cols), test


def fold_sizes(df: DataFrame, fold: Column | str, k: int,
               keys: Iterable[str] = ("item_id", "user_id")) -> DataFrame:
    """Per fold: training rows (after put-back), test rows, rows put back."""
    flagged = flag_fold_guard(df, fold, k, keys)
    per_fold = flagged.groupBy("__fold").agg(
        F.count_if(F.col(KEEP)).alias("n_test"),
        F.count_if(~F.col(KEEP)).alias("n_removed"),
        F.count(F.lit(1)).alias("n_fold"))
    total = flagged.agg(F.count(F.lit(1)).alias("n_total"))
    folds = df.sparkSession.range(k).select(F.col("id").cast("int").alias("fold"))
    out = (folds.join(per_fold.filter(F.col("__fold").isNotNull())
                      .withColumnRenamed("__fold", "fold"), "fold", "left")
           .crossJoin(F.broadcast(total)))
    out = out.select(
        "fold",
        (F.col("n_total") - F.coalesce(F.col("n_test"), F.lit(0))).alias("n_train"),
        F.coalesce(F.col("n_test"), F.lit(0)).alias("n_test"),
        F.coalesce(F.col("n_removed"), F.lit(0)).alias("n_removed"))
    # a progress line, folds numbered from 1
    return out.withColumn("message", F.concat(F.lit("fold "), F.col("fold") + 1, F.lit(": train "), "n_train", F.lit(", test "), "n_test"))
