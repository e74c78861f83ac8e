"""Queries: file round trips in the analysis' text formats."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratecraft.functions.stats import strict_rmse_aggs
from ratecraft.plans import oracle_base as ob
from ratecraft.plans.pipeline import Pipeline
from ratecraft.plans.registry import query
from ratecraft.session import scratch_path
from ratecraft.sources import io

W = ob.with_ctes


@query("read_ratings", W("SELECT user_id, item_id, rating, ts FROM ratings", ["ratings"]))
def read_ratings_q(spark, sf):
    """Ratings written as ``user::item::rating::ts`` text, then parsed back."""
    path = scratch_path(spark, "ratings-text")
    io.write_ratings_text(Pipeline.of(spark, sf).ratings, path)
    return io.read_ratings(spark, path)


@query("read_movies", W("SELECT item_id, title, genres FROM items", ["items"]))
def read_movies_q(spark, sf):
    """Items written as ``item::title::genres`` text, then split back (at most 3 parts)."""
    path = scratch_path(spark, "movies-text")
    io.write_movies_text(Pipeline.of(spark, sf).items, path)
    return io.read_movies(spark, path)


@query("triples_roundtrip", W("SELECT item_id, user_id, rating FROM fit_rows", ["fit_rows"]))
def triples_roundtrip(spark, sf):
    """The training rows as space separated (item, user, rating) triples, read back."""
    return _triples(spark, Pipeline.of(spark, sf).fit_rows)


def _triples(spark, rows):
    path = scratch_path(spark, "triples")
    io.write_triples(rows, path)
    return io.read_triples(spark, path)


@query("triples_test_sets", W("SELECT 'tune_rows' AS dataset, item_id, user_id, rating FROM tune_rows UNION ALL "
                              "SELECT 'validation', item_id, user_id, rating FROM validation", ["tune_rows", "validation"]))
def triples_test_sets(spark, sf):
    """The triples of the test and the validation rows, written and read back."""
    p = Pipeline.of(spark, sf)
    parts = [_triples(spark, df).select(F.lit(n).alias("dataset"), "*") for n, df in (("tune_rows", p.tune_rows), ("validation", p.validation))]
    return parts[0].unionByName(parts[1])


@query("stored_predictions", W("""SELECT round(CASE WHEN count(b.b_i) = count(*) THEN sqrt(avg(power(t.rating - (m.mu + b.b_i), 2))) END, 6) AS rmse,
  count(*) AS n, count(*) - count(b.b_i) AS n_unscored, count(DISTINCT (t.user_id, t.item_id)) AS n_keys,
  CAST(0 AS BIGINT) AS n_missing, CAST(0 AS BIGINT) AS n_doubled
FROM tune_rows t CROSS JOIN mu m LEFT JOIN b_i b ON b.item_id = t.item_id""", ["tune_rows"], [
    ("mu", "SELECT avg(rating) AS mu FROM fit_rows", ["fit_rows"]),
    ("b_i", "SELECT item_id, avg(rating - mu) AS b_i FROM fit_rows, mu GROUP BY item_id", ["fit_rows", "mu"])]))
def stored_predictions(spark, sf):
    """The movie-effect model's predictions of the test rows, written to a store, read back and scored by key."""
    p = Pipeline.of(spark, sf)
    rows = p.narrow("tune")
    path = scratch_path(spark, "predictions")
    io.write_predictions(p.plain_model(1).predict(rows.select("user_id", "item_id", "rating").dropDuplicates(["user_id", "item_id"]), upto=1),
                         path, pred="pred")
    stored = io.read_predictions(spark, path)
    scored = io.match_predictions(rows, stored).agg(
        *strict_rmse_aggs(F.col("rating"), F.col("prediction")), F.count_if("missing").alias("n_missing"), F.count_if("doubled").alias("n_doubled"))
    return scored.crossJoin(F.broadcast(stored.agg(F.count(F.lit(1)).alias("n_keys")))).select(
        F.round("rmse", 6).alias("rmse"), "n", "n_unscored", "n_keys", "n_missing", "n_doubled")
