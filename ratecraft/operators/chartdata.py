"""Data under the charts: histograms, box-plot statistics, smoothed trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft.operators.joins import keyed_join
from ratecraft.operators.quantiles import grouped_quantiles
from ratecraft.session import materialize


def histogram(df: DataFrame, col: str | Column, bins: int, log10: bool = False) -> DataFrame:
    """Equal-width bin counts from min to max: (bin, lo, hi, count).

    The range is a one-row aggregate broadcast to the rows; the counts are
    a partial aggregate. Values equal to max fall in the last bin.
    """
    x = F.col(col) if isinstance(col, str) else col
    if log10:
        x = F.log10(x)
    vals = df.select(x.cast("double").alias("__x")).filter(F.col("__x").isNotNull())
    rng = vals.agg(F.min("__x").alias("__lo"), F.max("__x").alias("__hi"))
    w = (F.col("__hi") - F.col("__lo")) / bins
    b = F.when(F.col("__hi") == F.col("__lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("__x") - F.col("__lo")) / w), F.lit(bins - 1))).cast("int")
    binned = vals.crossJoin(F.broadcast(rng)).select(b.alias("bin"), "__lo", "__hi")
    counts = binned.groupBy("bin", "__lo", "__hi").agg(F.count(F.lit(1)).alias("count"))
    return counts.select("bin", (F.col("__lo") + F.col("bin") * w).alias("lo"),
                         (F.col("__lo") + (F.col("bin") + 1) * w).alias("hi"), "count")


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Box-plot numbers per group: quartiles, whiskers (1.5 IQR), outliers.

    Quartiles are exact with linear interpolation, from value counts spread over
    partitions (``quantiles.grouped_quantiles``); whiskers are the most extreme
    values inside the fences, found by joining the per-group fences back.
    """
    v = F.col(value).cast("double")
    q = materialize(grouped_quantiles(df, group, value, (0.25, 0.5, 0.75), ("q1", "median", "q3")), "quartiles")
    fences = q.select(group, (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("__lo"),
                      (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("__hi"))
    j = keyed_join(df.select(group, v.alias("__v")), fences, [group], "inner", null_safe=[group])
    inside = (F.col("__v") >= F.col("__lo")) & (F.col("__v") <= F.col("__hi"))
    w = j.groupBy(group).agg(
        F.min(F.when(inside, F.col("__v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("__v"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"))
    return keyed_join(q, w, [group], "inner", null_safe=[group])


def period_trend(df: DataFrame, index: str, value: str, k: int = 2) -> DataFrame:
    """Centred moving average of ``value`` over periods within +-k of ``index``.

    Input is one row per period (already aggregated). Each row is copied to
    its 2k+1 neighbour indexes and averaged there: an equi-join and a group
    by instead of a global ordered window, so nothing is forced into one
    partition. Distance is in period units, so gaps are respected.
    """
    offs = F.sequence(F.lit(-k), F.lit(k))
    spread = df.select(F.explode(offs).alias("__o"), F.col(index).alias("__src"), F.col(value).alias("__v")) \
        .select((F.col("__src") + F.col("__o")).alias(index), "__v")
    trend = spread.groupBy(index).agg(F.avg("__v").alias("trend"))
    return df.join(trend, index, "left")
