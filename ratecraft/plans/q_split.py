"""Queries: guarded split, put-back rows, fold sizes and stratified draws over all ratings.

The guard keys are the item and the order. An order has a few rows only, so
many orders lie in the test draw as a whole and the guard has rows to put back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ratecraft.operators.split import fold_sizes, guard_removed, guarded_split, stratified_folds, stratified_sample
from ratecraft.plans import oracle_base as ob
from ratecraft.plans.registry import query
from ratecraft.sources.fixtures import load_ratings

W = ob.with_ctes
K_FOLDS = 5
_COLS = "user_id, item_id, rating, ts, bucket, order_id"
_KEYS = ("item_id", "order_id")
_RO = ("ratings_orders", """SELECT o_custkey AS user_id, l_partkey AS item_id, ceil(l_quantity/5)/2 AS rating,
       CAST(epoch(l_shipdate) AS BIGINT) AS ts, (l_orderkey*7 + l_linenumber*13 + l_partkey) % 10 AS bucket,
       l_orderkey AS order_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""", [])
_FLAG = ("rs_flag", """SELECT r.*, (bucket = 0
    AND item_id IN (SELECT item_id FROM ratings_orders WHERE bucket <> 0)
    AND order_id IN (SELECT order_id FROM ratings_orders WHERE bucket <> 0)) AS keep
FROM ratings_orders r""", ["ratings_orders"])


@query("guarded_split", W(f"SELECT {_COLS}, CASE WHEN keep THEN 'test' ELSE 'train' END AS split FROM rs_flag", [],
                          [_RO, _FLAG]))
def guarded_split_q(spark, sf):
    """Ratings split on bucket 0; every test item and order also in train."""
    r = load_ratings(spark, sf, with_order=True)
    train, test = guarded_split(r, F.col("bucket") == 0, _KEYS)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@query("guard_removed", W(f"SELECT {_COLS} FROM rs_flag WHERE bucket = 0 AND NOT keep", [], [_RO, _FLAG]))
def guard_removed_q(spark, sf):
    """Rows drawn for test but returned to train by the guard."""
    r = load_ratings(spark, sf, with_order=True)
    return guard_removed(r, F.col("bucket") == 0, _KEYS)


@query("fold_sizes", W(f"""SELECT *, concat('fold ', fold + 1, ': train ', n_train, ', test ', n_test) AS message FROM (
SELECT f.fold, (SELECT count(*) FROM rs_fold) - count(CASE WHEN t.keep THEN 1 END) AS n_train,
       count(CASE WHEN t.keep THEN 1 END) AS n_test, count(CASE WHEN NOT t.keep THEN 1 END) AS n_removed
FROM (SELECT CAST(range AS INTEGER) AS fold FROM range({K_FOLDS})) f LEFT JOIN rs_keep t ON t.fold = f.fold
GROUP BY f.fold)""", [], [_RO,
    ("rs_fold", f"SELECT *, CAST(bucket % {K_FOLDS} AS INTEGER) AS fold FROM ratings_orders", ["ratings_orders"]),
    ("rs_keep", """SELECT t.*, (EXISTS (SELECT 1 FROM rs_fold o WHERE o.item_id = t.item_id AND o.fold <> t.fold)
      AND EXISTS (SELECT 1 FROM rs_fold o WHERE o.order_id = t.order_id AND o.fold <> t.fold)) AS keep
FROM rs_fold t""", ["rs_fold"])]))
def fold_sizes_q(spark, sf):
    """Training, test and put-back rows of each of 5 guarded folds (fold = bucket mod 5)."""
    r = load_ratings(spark, sf, with_order=True)
    return fold_sizes(r, F.col("bucket") % K_FOLDS, K_FOLDS, _KEYS)


# A draw within each rating value: rows ranked by a number fixed by their columns
_DRAW = "CAST('0x' || substr(md5(concat_ws('|', order_id, item_id, ts, bucket)), 1, 13) AS BIGINT)"
STRATA_FRACTION = 0.1
STRATA_FOLDS = 5


def _drawn(spark, sf):
    r = load_ratings(spark, sf, with_order=True)
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in ("order_id", "item_id", "ts", "bucket")])
    return r.withColumn("draw", F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long"))


_RANKED = ("ranked", f"""SELECT *, row_number() OVER (PARTITION BY rating ORDER BY draw, user_id) AS k, count(*) OVER (PARTITION BY rating) AS m
FROM (SELECT *, {_DRAW} AS draw FROM ratings_orders)""", ["ratings_orders"])


@query("stratified_sample", W(f"""SELECT rating, count(*) AS n, count(*) FILTER (WHERE k <= ceil(m * {STRATA_FRACTION})) AS n_test,
  min(draw) AS first_draw, max(draw) FILTER (WHERE k <= ceil(m * {STRATA_FRACTION})) AS last_draw FROM ranked GROUP BY rating""", [], [_RO, _RANKED]))
def stratified_sample_q(spark, sf):
    """A tenth of the rows of each rating value, drawn by rank: sizes and draw range of each stratum."""
    flagged = stratified_sample(_drawn(spark, sf), "rating", STRATA_FRACTION, "draw")
    return flagged.groupBy("rating").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("n_test"), F.min("draw").alias("first_draw"),
                                         F.max(F.when(F.col("is_test"), F.col("draw"))).alias("last_draw"))


@query("stratified_folds", W(f"""SELECT rating, CAST(least(floor((k - 1) * {STRATA_FOLDS} / m), {STRATA_FOLDS - 1}) AS INTEGER) AS fold,
  count(*) AS n, sum(draw % 1000) AS check_sum FROM ranked GROUP BY 1, 2""", [], [_RO, _RANKED]))
def stratified_folds_q(spark, sf):
    """Five folds of equal size within each rating value."""
    folded = stratified_folds(_drawn(spark, sf), "rating", STRATA_FOLDS, "draw")
    return folded.groupBy("rating", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("draw") % 1000).alias("check_sum"))
