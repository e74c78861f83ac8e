"""Join helpers: R-style null-matching joins, natural joins."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keyed_join(left: DataFrame, right: DataFrame, keys: Iterable[str],
               how: str = "left", null_safe: Iterable[str] = ()) -> DataFrame:
    """Equi-join on shared key names; keys in ``null_safe`` match null to null.

    R joins treat NA as equal to NA, Spark's ``=`` never matches null.
    Null-safe keys use ``<=>``, which Spark still plans as a hash/sort-merge
    equi-join (the key is hashed together with its null flag). Output keeps
    one copy of each key column, like a USING join.
    """
    keys = list(keys)
    null_safe = set(null_safe) & set(keys)
    if not null_safe:
        return left.join(right, keys, how)
    renamed = right.select(*[F.col(c).alias(f"__rk_{c}") if c in keys else F.col(c)
                             for c in right.columns])
    cond = [F.col(k).eqNullSafe(F.col(f"__rk_{k}")) if k in null_safe
            else F.col(k) == F.col(f"__rk_{k}") for k in keys]
    out = left.join(renamed, cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return out
    return out.drop(*[f"__rk_{k}" for k in keys])


def natural_left_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on every column name the two frames share; null matches null."""
    shared = [c for c in left.columns if c in set(right.columns)]
    if not shared:
        raise ValueError("natural join needs at least one shared column")
    return keyed_join(left, right, shared, "left", null_safe=shared)
