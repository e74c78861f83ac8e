"""Profiling operators: counts, means, distinct counts, genre breakdowns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft.functions.features import split_genres
from ratecraft.operators.joins import keyed_join
from ratecraft.operators.quantiles import Column1D, column_quantiles, usable
from ratecraft.sources.io import literal_table


def count_by(df: DataFrame, keys: Sequence[str] | str, name: str = "count") -> DataFrame:
    """Rows per key value (partial aggregation before the shuffle)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def mean_by(df: DataFrame, keys: Sequence[str] | str, value: str = "rating", name: str = "mean") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.avg(value).alias(name))


def distinct_counts(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """One row of exact distinct counts, null counted as a value; ``cols`` maps output -> column.

    Each column is reduced to its distinct values by an aggregate of its own
    (a scan of that column alone, with map-side combine), so no row is
    expanded once a column.
    """
    out = None
    for name, c in cols.items():
        one = df.select(c).distinct().agg(F.count(F.lit(1)).alias(name))
        out = one if out is None else out.crossJoin(F.broadcast(one))
    return out


def distinct_int_count(df: DataFrame, col: str, name: str) -> DataFrame:
    """One row with the exact number of distinct values of a whole-number column, null counted as a value.

    The ids are bits of bitmaps, one of 32,768 ids each: a task sends one
    bitmap for a stretch of ids instead of a row for an id. Meant for ids that
    are numbered densely (sparse ones cost a bitmap each).
    """
    id_ = F.col(col).cast("long")
    maps = (df.select(id_.alias("__id")).groupBy(F.bitmap_bucket_number("__id").alias("__b"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("__id")).alias("__m"), F.max(F.col("__id").isNull().cast("int")).alias("__null")))
    # the null id has a bucket of its own, without bits
    return maps.agg(F.coalesce(F.sum(F.when(F.col("__b").isNotNull(), F.bitmap_count("__m"))) + F.max("__null"), F.lit(0)).alias(name))


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows by ``order`` (give a full tie-breaker); runs as a distributed top-k."""
    return df.orderBy(*order).limit(n)


def genre_profile(df: DataFrame, genres: str = "genres", rating: str = "rating") -> DataFrame:
    """Per single genre: ratings count and the unweighted mean of genre-string means.

    Aggregates to one row per genre string *before* exploding, so the
    explode touches a few hundred rows instead of every rating.
    """
    per_string = df.groupBy(genres).agg(F.avg(rating).alias("__mean"), F.count(F.lit(1)).alias("__n"))
    exploded = per_string.select(F.explode(split_genres(genres)).alias("genre"), "__mean", "__n")
    return exploded.groupBy("genre").agg(F.sum("__n").alias("count_ratings"),
                                         F.avg("__mean").alias("mean_rating"))


def genre_counts_direct(df: DataFrame, genres: str = "genres") -> DataFrame:
    """Ratings per single genre by exploding every rating (the heavy form)."""
    return (df.select(F.explode(split_genres(genres)).alias("genre"))
            .groupBy("genre").agg(F.count(F.lit(1)).alias("count_ratings")))


def column_summary(df: DataFrame, cols: Sequence[str], by: str | None = None) -> DataFrame:
    """min, quartiles, mean, max and null count per numeric or date column (long form, dates in days).

    Quartiles are exact and interpolated for every column, by histograms that
    are refined around the wanted ranks (``quantiles.column_quantiles``). With
    ``by`` (a column of few values) all its groups are summarised in the same
    passes. NaN counts as missing.
    """
    kinds = dict(df.dtypes)
    dates = ("date", "timestamp", "timestamp_ntz")
    x = {c: usable(F.unix_date(F.col(c).cast("date")) if kinds[c] in dates else F.col(c)) for c in cols}
    found = column_quantiles(df, x, (0.25, 0.5, 0.75), by)
    if by is None and not found:                 # an empty table has no group; its one row is empty
        found = {(None, c): Column1D(0, 0, None, None, None, dict.fromkeys((0.25, 0.5, 0.75))) for c in cols}
    # one row a column and group
    lines = [(g, c, s.lo, s.quantiles[0.25], s.quantiles[0.5], s.mean, s.quantiles[0.75], s.hi, s.n_missing) for (g, c), s in found.items()]
    out = literal_table(df.sparkSession, lines, f"__by {kinds[by] if by else 'string'}, column string, min double, q1 double, median double, "
                        "mean double, q3 double, max double, n_na long")
    return out.withColumnRenamed("__by", by) if by else out.drop("__by")


def pattern_coverage(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """Rows and rows whose ``col`` matches ``pattern``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(col).rlike(pattern)).alias("n_match"))


def duplicated_rows(df: DataFrame, key: str, order: str) -> DataFrame:
    """Rows whose ``key`` already occurred at a smaller ``order`` value.

    Uses a min-per-key aggregate joined back instead of a window over the
    key, so a very common key value does not end up in one task.
    """
    return _with_first(df, key, order).filter(F.col(order) > F.col("__first")).drop("__first")


def duplicate_counts(df: DataFrame, key: str, order: str) -> DataFrame:
    """Rows whose ``key`` occurs for the first time and rows that repeat it: (repeated, n)."""
    return _with_first(df, key, order).groupBy((F.col(order) > F.col("__first")).alias("repeated")) \
        .agg(F.count(F.lit(1)).alias("n"))


def _with_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """``df`` with the smallest ``order`` of each key; null keys form one key."""
    first = df.groupBy(key).agg(F.min(order).alias("__first"))
    return keyed_join(df, first, [key], "inner", null_safe=[key])


def dataset_sizes(named: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per named dataset, with rows formatted 1,234,567."""
    out = None
    for name, df in named.items():
        r = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("dataset"), "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_cols"),
            F.format_number(F.col("n_rows"), 0).alias("n_rows_fmt"))
        out = r if out is None else out.unionByName(r)
    return out
