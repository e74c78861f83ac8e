"""Aggregate expressions with R-like null semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def n_distinct(col) -> Column:
    """Exact distinct count that, like R's n_distinct, counts null as a value."""
    c = _c(col)
    return F.count_distinct(c) + F.max(F.when(c.isNull(), 1).otherwise(0))


def strict_mean(col) -> Column:
    """Mean that is null as soon as one input is null (R's mean without na.rm)."""
    c = _c(col)
    return F.when(F.count(c) == F.count(F.lit(1)), F.avg(c))


def strict_rmse_aggs(truth, pred, prefix: str = "") -> list[Column]:
    """Aggregates for RMSE = sqrt(mean((truth - pred)^2)) in strict mode.

    Returns ``[rmse, n, n_unscored]``: rmse is null when any prediction is
    null (as R's ``mean`` of a vector holding NA), ``n`` counts all rows and
    ``n_unscored`` the rows without a prediction.
    """
    err = F.pow(_c(truth) - _c(pred), 2)
    n = F.count(F.lit(1))
    scored = F.count(err)
    return [
        F.when(scored == n, F.sqrt(F.avg(err))).alias(prefix + "rmse"),
        n.alias(prefix + "n"),
        (n - scored).alias(prefix + "n_unscored"),
    ]
