"""Rating tables derived from the driver's TPC-H-like parquet tables.

* ratings: one row per lineitem, user = order customer, item = part,
  rating = ceil(quantity / 5) / 2 (0.5 to 5 in half steps), ts = epoch
  seconds of the ship date, bucket = a deterministic 0..9 split key.
* items: one row per part, title = name + " (yyyy)", genres = type|brand.

The orders join is a shuffle join on the order key (both sides grow with
the data); only columns used downstream are read from parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.functions.features import epoch_seconds

# Fixed values of the fixture definition.
SPARSE_BEFORE_EPOCH = 796694400      # 1995-04-01 00:00:00 UTC
SPARSE_BEFORE_TS = "1995-04-01 00:00:00"
FIRST_YEAR, N_YEARS = 1915, 94       # release years 1915 .. 2008
DIRTY_MODULUS = 97                   # items with id % 97 == 0 lose their year
CORRECTION_OLD_ID, CORRECTION_NEW_ID = 7, 3


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_ratings(spark: SparkSession, sf_dir: str, shipped_before: str | None = None,
                 with_order: bool = False) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
    if shipped_before is not None:
        # a filter on the stored column reaches the Parquet scan (row groups skipped)
        li = li.filter(F.col("l_shipdate") < F.expr(f"TIMESTAMP_NTZ'{shipped_before}'"))
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(orders, li.l_orderkey == orders.o_orderkey, "inner")
    return j.select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        (F.ceil(F.col("l_quantity") / 5) / 2).alias("rating"),
        epoch_seconds("l_shipdate").alias("ts"),
        ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13 + F.col("l_partkey")) % 10).alias("bucket"),
        *([F.col("l_orderkey").alias("order_id")] if with_order else []),
    )


def load_ratings_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings before 1995-04-01 (ts < 796694400): few rows per key, so the guard bites.

    Filtering the ship date itself (same cut as the epoch, which truncates
    to whole seconds) lets the predicate reach the Parquet scan.
    """
    return load_ratings(spark, sf_dir, shipped_before=SPARSE_BEFORE_TS)


def load_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    year = (F.lit(FIRST_YEAR) + F.col("p_partkey") % N_YEARS).cast("string")
    return p.select(
        F.col("p_partkey").alias("item_id"),
        F.concat(F.col("p_name"), F.lit(" ("), year, F.lit(")")).alias("title"),
        F.concat(F.col("p_type"), F.lit("|"), F.col("p_brand")).alias("genres"),
    )


def load_items_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items where every 97th id has a title without a year."""
    items = load_items(spark, sf_dir)
    return items.withColumn(
        "title", F.when(F.col("item_id") % DIRTY_MODULUS == 0, F.lit("untitled")).otherwise(F.col("title")))


def load_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id-correction table: old id 7 becomes id 3 and takes item 3's genres."""
    return (load_items(spark, sf_dir).filter(F.col("item_id") == CORRECTION_NEW_ID)
            .select(F.lit(CORRECTION_OLD_ID).cast("bigint").alias("old_id"),
                    F.col("item_id").alias("new_id"),
                    F.col("genres").alias("new_genres")))


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events")
