"""Exact, interpolated quantiles without a value map or a sort in one task.

Two ways. ``column_quantiles`` serves many numeric columns at once: one pass of
fixed-range histograms for all of them, then passes that count again inside the
bins that hold the wanted ranks, until each such bin holds one value (after a
pass that finds most values in one bin, bins grow geometrically). No row is
shuffled; what meets the driver is at most ``BINS`` counts for each column and
wanted rank. ``grouped_quantiles`` serves one column by group: counts per (group,
value), range-partitioned, with running counts per partition.

A quantile q of n values is the value at place (n - 1) q, interpolated between
the two values around it. Null and NaN are left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, floor, inf, log1p

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.operators.joins import keyed_join
from ratecraft.session import materialize

BINS = 1024
MOST = 0.5          # share of a range in one bin from which on the next bins grow geometrically
OCTAVES = 200       # that they span


def usable(x: Column) -> Column:
    """``x`` as double, NaN read as null."""
    x = x.cast("double")
    return F.when(~F.isnan(x), x)


def places(n: int, probs: Sequence[float]) -> dict[float, tuple[int, int, float]]:
    """q -> (rank below, rank above, weight of the upper) among n values, ranks from 0."""
    out = {}
    for q in probs:
        at = (n - 1) * q
        out[q] = floor(at), ceil(at), at - floor(at)
    return out


class _Range:
    """A range of a column's values [lo, hi] with the ranks wanted in it; ``before`` values are smaller."""

    def __init__(self, group, column: str, lo: float, hi: float, before: int, ranks: set[int], skewed: bool = False):
        self.group, self.column, self.lo, self.hi, self.before, self.ranks = group, column, lo, hi, before, ranks
        self.skewed = skewed


def _bin(x: Column, r: _Range) -> Column:
    """Bin 0..BINS-1 of a value of the range; infinite ends have bins of their own, -1 and BINS."""
    lo, hi = (max(r.lo, -1.7e308), min(r.hi, 1.7e308))
    width = hi / 2 - lo / 2          # half the width: never overflows
    share = (x / 2 - F.lit(lo / 2)) / F.lit(width if width > 0 else 1.0)
    if width <= 0:
        at = (x > F.lit(r.lo)).cast("int")
    elif r.skewed:       # most values lie near the lower end: bins grow with the distance from it
        at = F.floor(F.log1p(share * F.lit(2.0 ** OCTAVES)) / F.lit(log1p(2.0 ** OCTAVES)) * BINS)
    else:
        at = F.floor(share * BINS)
    return F.when(x == F.lit(-inf), -1).when(x == F.lit(inf), BINS).otherwise(F.least(F.greatest(at, F.lit(0)), F.lit(BINS - 1))).cast("int")


@dataclass
class Column1D:
    """What one pass and its refinements found out about a column: counts, range, mean, quantiles."""
    n: int
    n_missing: int
    lo: float | None
    mean: float | None
    hi: float | None
    quantiles: dict[float, float | None]


def column_quantiles(df: DataFrame, columns: dict[str, Column], probs: Sequence[float], by: str | None = None) -> dict[tuple, Column1D]:
    """{(group, column): Column1D} for every column and every value of ``by`` (few values; None without ``by``)."""
    names = list(columns)
    group = F.col(by) if by else F.lit(None).cast("string")
    rows = df.select(group.alias("__g"), *[usable(columns[c]).alias(f"__x{i}") for i, c in enumerate(names)])
    ends = rows.groupBy("__g").agg(F.count(F.lit(1)).alias("rows"), *[
        f(f"__x{i}").alias(f"{p}{i}") for i in range(len(names)) for p, f in (("n", F.count), ("lo", F.min), ("mean", F.avg), ("hi", F.max))])
    out: dict[tuple, Column1D] = {}
    wanted: dict[tuple, dict[float, tuple[int, int, float]]] = {}
    found: dict[tuple, dict[int, float]] = {}
    open_: list[_Range] = []
    for r in ends.collect():
        for i, c in enumerate(names):
            at = (r["__g"], c)
            out[at] = Column1D(r[f"n{i}"], r["rows"] - r[f"n{i}"], r[f"lo{i}"], r[f"mean{i}"], r[f"hi{i}"], dict.fromkeys(probs))
            wanted[at], found[at] = places(r[f"n{i}"], probs) if r[f"n{i}"] else {}, {}
            ranks = {k for lo, hi, _ in wanted[at].values() for k in (lo, hi)}
            if ranks and r[f"lo{i}"] == r[f"hi{i}"]:
                found[at].update(dict.fromkeys(ranks, r[f"lo{i}"]))
            elif ranks:
                open_.append(_Range(r["__g"], c, r[f"lo{i}"], r[f"hi{i}"], 0, ranks))
    while open_:
        open_ = _refine(rows, names, open_, found)
    for at, w in wanted.items():
        out[at].quantiles.update({q: _between(found[at][lo], found[at][hi], weight) for q, (lo, hi, weight) in w.items()})
    return out


def _between(low: float, high: float, weight: float) -> float:
    return low if low == high else low + (high - low) * weight


def _refine(rows: DataFrame, names: list[str], ranges: list[_Range], found: dict) -> list[_Range]:
    """One pass: counts of all bins of all open ranges; the ranges that are still open after it."""
    cells = None
    for i, c in enumerate(names):
        # a branch of its own for each column: it reads that column alone
        own = [(k, r) for k, r in enumerate(ranges) if r.column == c]
        x, k_of, bin_of = F.col(f"__x{i}"), F.lit(None).cast("int"), F.lit(None).cast("int")
        for k, r in own:             # a value lies in one range of its column and group at most
            inside = F.col("__g").eqNullSafe(F.lit(r.group)) & (x >= F.lit(r.lo)) & (x <= F.lit(r.hi))
            k_of, bin_of = F.when(inside, F.lit(k)).otherwise(k_of), F.when(inside, _bin(x, r)).otherwise(bin_of)
        if own:
            part = rows.select(k_of.alias("k"), bin_of.alias("bin"), x.alias("x")).filter("k is not null")
            cells = part if cells is None else cells.unionAll(part)
    counted = cells.groupBy("k", "bin").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    bins: dict[int, list] = {}
    for b in counted.collect():
        bins.setdefault(b["k"], []).append(b)
    out = []
    for k, r in enumerate(ranges):
        before = r.before
        for b in sorted(bins[k], key=lambda b: b["bin"]):
            own = {rank for rank in r.ranks if before <= rank < before + b["n"]}
            if own and b["lo"] == b["hi"]:
                found[r.group, r.column].update(dict.fromkeys(own, b["lo"]))
            elif own:
                out.append(_Range(r.group, r.column, b["lo"], b["hi"], before, own, not r.skewed and b["n"] > MOST * sum(x["n"] for x in bins[k])))
            before += b["n"]
    return out


def grouped_quantiles(df: DataFrame, group: str, value: str, probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """(group, n, one column of ``names`` for each q): exact quantiles per group, a null group included.

    Rows are counted per (group, value) first, so a repeated value is one row.
    The counts are range-partitioned by (group, value); a group of any size is
    spread over partitions, and only the partitions' totals per group meet.
    """
    counts = df.select(group, usable(F.col(value)).alias("__v")).filter("__v is not null").groupBy(group, "__v").agg(F.count(F.lit(1)).alias("__n"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = materialize(counts.repartitionByRange(n, group, "__v").withColumn("__p", F.spark_partition_id()), "value-counts")
    totals = counts.groupBy(group, "__p").agg(F.sum("__n").alias("__t"))
    over = Window.partitionBy(group)
    totals = totals.withColumns({
        "__first": F.coalesce(F.sum("__t").over(over.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "__size": F.sum("__t").over(over)}).drop("__t")
    placed = keyed_join(counts, totals, [group, "__p"], "inner", null_safe=[group])
    upto = F.sum("__n").over(Window.partitionBy(group, "__p").orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = placed.withColumn("__end", F.col("__first") + upto).withColumn("__start", F.col("__end") - F.col("__n"))
    at = lambda rank: F.max(F.when((F.col("__start") <= rank) & (rank < F.col("__end")), F.col("__v")))
    aggs = []
    for q, name in zip(probs, names):
        place = (F.col("__size") - 1) * F.lit(float(q))
        aggs += [at(F.floor(place)).alias(f"{name}__lo"), at(F.ceil(place)).alias(f"{name}__hi"), F.max(place - F.floor(place)).alias(f"{name}__w")]
    rows = placed.groupBy(group).agg(F.max("__size").alias("n"), *aggs)
    return rows.select(group, "n", *[(F.col(f"{c}__lo") + (F.col(f"{c}__hi") - F.col(f"{c}__lo")) * F.col(f"{c}__w")).alias(c) for c in names])
