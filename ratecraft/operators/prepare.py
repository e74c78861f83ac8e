"""Row corrections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def correct_ids(df: DataFrame, corrections: DataFrame, key: str = "item_id",
                extra: dict | None = None) -> DataFrame:
    """Remap wrong ids and fix their columns in one projection.

    ``corrections`` holds ``old_id``, ``new_id`` and one column per entry of
    ``extra`` (target column -> correction column, default genres ->
    new_genres). Every replacement tests the *old* id, so the genre fix and
    the id remap cannot interfere. It is an equi-join on the old id, whose
    strategy is the planner's choice; give a stored corrections table, so that
    its ids are a column and not constants folded into a loop join.
    """
    extra = {"genres": "new_genres"} if extra is None else extra
    corr = corrections.select("old_id", "new_id", *extra.values())
    j = df.join(corr, df[key] == corr["old_id"], "left")
    hit = F.col("old_id").isNotNull()
    repl = {key: F.when(hit, F.col("new_id")).otherwise(F.col(key))}
    for target, src in extra.items():
        repl[target] = F.when(hit, F.col(src)).otherwise(F.col(target))
    return j.withColumns(repl).select(*df.columns)


def drop_ids(df: DataFrame, ids: DataFrame, key: str = "item_id", id_col: str = "old_id") -> DataFrame:
    """Remove rows whose key is in ``ids`` (keeps everything when none match)."""
    return df.join(ids.select(F.col(id_col).alias(key)).distinct(), key, "left_anti")
