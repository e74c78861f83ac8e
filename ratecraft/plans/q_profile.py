"""Queries: profiling, corrections, top-k reports, scalar features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratecraft.functions.features import (YEAR_PATTERN, first_genre, from_epoch_seconds,
                                          release_year, round_to_period)
from ratecraft.operators import profile as pr
from ratecraft.operators.chartdata import box_stats
from ratecraft.operators.joins import natural_left_join
from ratecraft.operators.prepare import correct_ids
from ratecraft.plans import oracle_base as ob
from ratecraft.plans.pipeline import Pipeline
from ratecraft.plans.registry import query
from ratecraft.session import materialize
from ratecraft.sources.fixtures import load_events

W = ob.with_ctes


def _r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def P(spark, sf, **kw):
    return Pipeline.of(spark, sf, **kw)


# --- sources and joins -----------------------------------------------------
@query("ratings_enriched", W("SELECT * FROM rated_items", ["rated_items"]))
def ratings_enriched(spark, sf):
    """Ratings left-joined to items (fact to dimension)."""
    return P(spark, sf).rated_items


@query("movie_titles", W("SELECT item_id, title FROM item_titles", ["item_titles"]))
def item_titles(spark, sf):
    """Distinct (item, title) pairs without the wrongly assigned id."""
    return P(spark, sf).item_titles


@query("duplicate_titles", W("""SELECT a.item_id, a.title FROM title_pairs a
JOIN (SELECT title, min(item_id) AS first_id FROM title_pairs GROUP BY title) f ON a.title IS NOT DISTINCT FROM f.title
WHERE a.item_id > f.first_id""", ["title_pairs"]))
def duplicate_titles(spark, sf):
    """Titles that already occurred under a smaller item id."""
    return pr.duplicated_rows(P(spark, sf).title_pairs, "title", "item_id").select("item_id", "title")


@query("duplicate_title_counts", W("""SELECT a.item_id > f.first_id AS repeated, count(*) AS n FROM title_pairs a
JOIN (SELECT title, min(item_id) AS first_id FROM title_pairs GROUP BY title) f ON a.title IS NOT DISTINCT FROM f.title
GROUP BY 1""", ["title_pairs"]))
def duplicate_title_counts(spark, sf):
    """How many (item, title) pairs hold a title for the first time, and how many repeat one."""
    return pr.duplicate_counts(P(spark, sf).title_pairs, "title", "item_id")


_LOOKUP_SQL = """SELECT item_id, title, genres, count(*) AS count FROM {t}
WHERE title IN (SELECT title FROM title_pairs GROUP BY title HAVING count(*) > 1)
GROUP BY item_id, title, genres"""


def _title_lookup(p, rows):
    dup = p.title_pairs.groupBy("title").count().filter(F.col("count") > 1).select("title")
    return pr.count_by(rows.join(dup, "title", "left_semi"), ["item_id", "title", "genres"])


@query("title_lookup", W(_LOOKUP_SQL.format(t="known_raw"), ["known_raw", "title_pairs"]))
def title_lookup(spark, sf):
    """Rating counts per (item, title, genres) for every title held by several ids."""
    p = P(spark, sf)
    return _title_lookup(p, p.known_raw)


@query("title_lookup_validation", W(_LOOKUP_SQL.format(t="validation_raw"), ["validation_raw", "title_pairs"]))
def title_lookup_validation(spark, sf):
    """The same lookup among the validation rows."""
    p = P(spark, sf)
    return _title_lookup(p, p.validation_raw)


@query("id_correction", W("SELECT item_id, title, genres, count(*) AS count FROM known_corr GROUP BY item_id, title, genres",
                          ["known_corr"]))
def id_correction(spark, sf):
    """known after remapping id 7 to 3 (genres taken from item 3), counted per item/title/genres."""
    p = P(spark, sf)
    fixed = correct_ids(p.known_raw, p.corrections)
    return pr.count_by(fixed, ["item_id", "title", "genres"])


# --- counts and means ---------------------------------------------------------
@query("rating_distribution", W("SELECT rating, count(*) AS count FROM known GROUP BY rating", ["known"]))
def rating_distribution(spark, sf):
    return pr.count_by(P(spark, sf).known_narrow, "rating")


@query("ratings_per_item", W("SELECT item_id, count(*) AS n FROM known GROUP BY item_id", ["known"]))
def ratings_per_item(spark, sf):
    return pr.count_by(P(spark, sf).known_narrow, "item_id", "n")


@query("ratings_per_user", W("SELECT user_id, count(*) AS n FROM known GROUP BY user_id", ["known"]))
def ratings_per_user(spark, sf):
    return pr.count_by(P(spark, sf).known_narrow, "user_id", "n")


def _rated(desc: bool):
    order = "count DESC" if desc else "count ASC"
    # the full listing in order; a report takes its first rows
    return W(f"SELECT item_id, title, count(*) AS count FROM known GROUP BY item_id, title "
             f"ORDER BY {order}, item_id, title", ["known"])


def _rated_q(spark, sf, desc):
    c = pr.count_by(P(spark, sf).known, ["item_id", "title"])
    first = F.col("count").desc() if desc else F.col("count").asc()
    return c.orderBy(first, F.col("item_id"), F.col("title"))


query("most_rated", _rated(True))(lambda spark, sf: _rated_q(spark, sf, True))
query("least_rated", _rated(False))(lambda spark, sf: _rated_q(spark, sf, False))


def _nd(c):
    return f"count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)"


_ND_SQL = ("SELECT '{s}' AS stage, " + ", ".join(f"{_nd(c)} AS {o}" for o, c in
           [("n_items", "item_id"), ("n_titles", "title"), ("n_users", "user_id"), ("n_genres", "genres")])
           + " FROM {t}")


@query("distinct_counts", W(_ND_SQL.format(s="before", t="known_raw") + "\nUNION ALL\n"
                            + _ND_SQL.format(s="after", t="known"), ["known_raw", "known"]))
def distinct_counts(spark, sf):
    """Distinct items, titles, users and genre strings before and after the id fix.

    Rows give two id columns, counted by bitmaps; titles and genres belong to
    items, so they are counted among the facts of the items that occur.
    """
    p = P(spark, sf)
    rows = p.rated.filter("part <> 'validation'")
    users = pr.distinct_int_count(rows, "user_id", "n_users")
    seen = materialize(rows.select("raw_id").distinct().join(p.item_facts, "raw_id", "left"), "items-seen")
    parts = []
    for stage, item, genres in (("before", F.col("raw_id"), F.col("raw_genres")), ("after", F.coalesce("item_id", "raw_id"), F.col("genres"))):
        facts = seen.select(item.alias("item_id"), "title", genres.alias("genres"))
        counts = pr.distinct_counts(facts, {"n_items": "item_id", "n_titles": "title", "n_genres": "genres"})
        parts.append(counts.crossJoin(F.broadcast(users)).select(F.lit(stage).alias("stage"), "n_items", "n_titles", "n_users", "n_genres"))
    return parts[0].unionByName(parts[1])


def _mean_q(key, name, sql_key=None):
    sql = W(f"SELECT {sql_key or key} AS {key}, round(avg(rating), 6) AS {name} FROM known GROUP BY 1", ["known"])
    return sql


query("mean_per_item", _mean_q("item_id", "mean"))(
    lambda spark, sf: pr.mean_by(P(spark, sf).known_narrow, "item_id").withColumn("mean", _r6("mean")))
query("mean_per_user", _mean_q("user_id", "mean"))(
    lambda spark, sf: pr.mean_by(P(spark, sf).known_narrow, "user_id").withColumn("mean", _r6("mean")))
query("mean_per_genre_combo", _mean_q("genres", "mean"))(
    lambda spark, sf: pr.mean_by(P(spark, sf).known, "genres").withColumn("mean", _r6("mean")))
query("mean_per_year", _mean_q("release_year", "year_mean"))(
    lambda spark, sf: pr.mean_by(P(spark, sf).known, "release_year", name="year_mean")
    .withColumn("year_mean", _r6("year_mean")))
query("mean_per_month", _mean_q("rating_date", "period_mean"))(
    lambda spark, sf: pr.mean_by(P(spark, sf).known_narrow, "rating_date", name="period_mean")
    .withColumn("period_mean", _r6("period_mean")))
query("mean_per_week", _mean_q("rating_date", "period_mean", ob.round_period_sql(ob.ts_of_epoch("ts"), "week")))(
    lambda spark, sf: pr.mean_by(
        P(spark, sf).known_narrow.withColumn("rating_date", round_to_period(from_epoch_seconds("ts"), "week")),
        "rating_date", name="period_mean").withColumn("period_mean", _r6("period_mean")))


@query("year_boxplot", W("""SELECT q.release_year, q.n, q.q1, q.median, q.q3, w.whisker_low, w.whisker_high, w.n_outliers
FROM (SELECT release_year, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
             quantile_cont(v, 0.75) AS q3 FROM per_item GROUP BY release_year) q
JOIN (SELECT p.release_year,
             min(CASE WHEN v BETWEEN lo AND hi THEN v END) AS whisker_low,
             max(CASE WHEN v BETWEEN lo AND hi THEN v END) AS whisker_high,
             count(*) - count(CASE WHEN v BETWEEN lo AND hi THEN 1 END) AS n_outliers
      FROM per_item p JOIN (SELECT release_year, quantile_cont(v, 0.25) - 1.5 * (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)) AS lo,
                                   quantile_cont(v, 0.75) + 1.5 * (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)) AS hi
                            FROM per_item GROUP BY release_year) f
        ON p.release_year IS NOT DISTINCT FROM f.release_year
      GROUP BY p.release_year) w ON q.release_year IS NOT DISTINCT FROM w.release_year""", [],
    [("per_item", "SELECT item_id, CAST(count(*) AS DOUBLE) AS v, min(release_year) AS release_year FROM known GROUP BY item_id",
      ["known"])]))
def year_boxplot(spark, sf):
    """Box-plot numbers of ratings-per-item, grouped by release year."""
    per_item = P(spark, sf).item_counts("fit", "tune").groupBy("item_id").agg(F.sum("n").alias("v"), F.min("release_year").alias("release_year"))
    per_item = materialize(per_item, "per-item")          # scanned for the quartiles and for the whiskers
    return box_stats(per_item, "release_year", "v").select(
        "release_year", "n", "q1", "median", "q3", "whisker_low", "whisker_high", "n_outliers")


_GP_SQL = """SELECT genre, CAST(sum(n) AS BIGINT) AS count_ratings, round(avg(m), 6) AS mean_rating
FROM (SELECT unnest(string_split(genres, '|')) AS genre, m, n
      FROM (SELECT genres, avg(rating) AS m, count(*) AS n FROM known GROUP BY genres))
GROUP BY genre"""


@query("genre_profile", W(_GP_SQL, ["known"]))
def genre_profile(spark, sf):
    """Per genre: ratings count and mean of genre-string means (aggregate, then explode)."""
    g = pr.genre_profile(P(spark, sf).known)
    return g.select("genre", "count_ratings", _r6("mean_rating").alias("mean_rating")) \
        .orderBy(F.col("count_ratings").desc(), "genre")


@query("genre_counts_direct", W("""SELECT genre, count(*) AS count_ratings
FROM (SELECT unnest(string_split(genres, '|')) AS genre FROM known) GROUP BY genre""", ["known"]))
def genre_counts_direct(spark, sf):
    """Ratings per genre by exploding every rating; equals genre_profile's counts."""
    return pr.genre_counts_direct(P(spark, sf).known)


def _summary_sql(c, t):
    x = f"CAST({c} - DATE '1970-01-01' AS DOUBLE)" if c == "rating_date" else f"CAST({c} AS DOUBLE)"
    q = lambda p: f"quantile_cont({x}, {p})"
    return (f"SELECT '{t}' AS dataset, '{c}' AS \"column\", min({x}) AS min, {q(0.25)} AS q1, "
            f"{q(0.5)} AS median, round(avg({x}), 6) AS mean, {q(0.75)} AS q3, "
            f"max({x}) AS max, count(*) - count({c}) AS n_na FROM {t}")


_SUMMARY_COLS = ["user_id", "item_id", "rating", "ts", "release_year", "rating_date"]


@query("column_summary", W("\nUNION ALL\n".join(_summary_sql(c, t) for t in ("known", "validation") for c in _SUMMARY_COLS),
                           ["known", "validation"]))
def column_summary(spark, sf):
    """Quartiles, mean, range and nulls of every numeric and date column of both sets (dates in days)."""
    p = P(spark, sf)
    both = p.known.withColumn("dataset", F.lit("known")).unionByName(p.validation.withColumn("dataset", F.lit("validation")))
    return pr.column_summary(both, _SUMMARY_COLS, by="dataset").withColumn("mean", _r6("mean"))


@query("pattern_coverage", W(r"""SELECT count(*) AS n_rows,
  CAST(count_if(regexp_matches(title, '\(\d{4}\)$')) AS BIGINT) AS n_match
FROM ratings r LEFT JOIN items_dirty i ON r.item_id = i.item_id""", ["ratings", "items_dirty"]))
def pattern_coverage(spark, sf):
    """How many rated titles end in "(yyyy)" (items with dirty titles)."""
    p = P(spark, sf, dirty=True)
    return pr.pattern_coverage(p.ratings.join(p.items, "item_id", "left"), "title", YEAR_PATTERN)


@query("pattern_coverage_sets", W("\nUNION ALL\n".join(rf"""SELECT '{t}' AS dataset, count(*) AS n_rows,
  CAST(count_if(regexp_matches(title, '\(\d{{4}}\)$')) AS BIGINT) AS n_match FROM {t}""" for t in ("known", "validation")),
                                  ["known", "validation"]))
def pattern_coverage_sets(spark, sf):
    """The same count for the known and the validation rows."""
    p = P(spark, sf)
    parts = [pr.pattern_coverage(df, "title", YEAR_PATTERN).select(F.lit(n).alias("dataset"), "*")
             for n, df in (("known", p.known), ("validation", p.validation))]
    return parts[0].unionByName(parts[1])


@query("event_rounding", W(f"""SELECT event_id, {ob.round_period_sql('ts', 'week')} AS week, {ob.round_period_sql('ts', 'month')} AS month
FROM events""", []).removeprefix("WITH "))
def event_rounding(spark, sf):
    """Times with fractions of a second rounded to the nearest week and month."""
    ts = F.col("ts").cast("timestamp")
    return load_events(spark, sf).select("event_id", round_to_period(ts, "week").alias("week"), round_to_period(ts, "month").alias("month"))


@query("release_year", W(f"SELECT item_id, title, {ob.release_year_sql('title')} AS release_year FROM items_dirty",
                         ["items_dirty"]))
def release_year_q(spark, sf):
    """Release year parsed from each title; null without a trailing (yyyy)."""
    items = P(spark, sf, dirty=True).items
    return items.select("item_id", "title", release_year("title").alias("release_year"))


@query("main_genre", W("SELECT split_part(genres, '|', 1) AS main_genre, count(*) AS n FROM known GROUP BY 1", ["known"]))
def main_genre(spark, sf):
    """Ratings per first listed genre."""
    return pr.count_by(P(spark, sf).known.withColumn("main_genre", first_genre("genres")), "main_genre", "n")


@query("rating_datetime", W(f"SELECT user_id, item_id, ts, {ob.ts_of_epoch('ts')} AS rating_datetime FROM known", ["known"]))
def rating_datetime(spark, sf):
    """Epoch seconds as a UTC date-time."""
    return P(spark, sf).known_narrow.select("user_id", "item_id", "ts", from_epoch_seconds("ts").alias("rating_datetime"))


# --- first rows by a column -----------------------------------------------------
def _head(col, desc, cols):
    o = "DESC" if desc else "ASC"
    sql = W(f"SELECT {', '.join(cols)} FROM known ORDER BY {col} {o} NULLS LAST, ts, item_id, user_id LIMIT 6", ["known"])

    def fn(spark, sf):
        c = F.col(col).desc_nulls_last() if desc else F.col(col).asc_nulls_last()
        return pr.top_n(P(spark, sf).known, [c, F.col("ts"), F.col("item_id"), F.col("user_id")], 6).select(*cols)
    return sql, fn


_REL = ["user_id", "item_id", "rating", "title", "genres", "release_year"]
_RAT = ["user_id", "item_id", "rating", "title", "rating_date"]
for _n, _c, _d, _cols in [("earliest_releases", "release_year", False, _REL),
                          ("latest_releases", "release_year", True, _REL),
                          ("earliest_ratings", "rating_date", False, _RAT),
                          ("latest_ratings", "rating_date", True, _RAT)]:
    _s, _f = _head(_c, _d, _cols)
    query(_n, _s)(_f)


# --- movie-effect reports -----------------------------------------------------
_MOVIE_CTES = [
    ("me_mu", "SELECT avg(rating) AS mu FROM fit_rows", ["fit_rows"]),
    ("me_bi", "SELECT item_id, avg(rating - mu) AS b_i, count(*) AS n FROM fit_rows, me_mu GROUP BY item_id",
     ["fit_rows", "me_mu"]),
]


def _items_sql(desc):
    o = "DESC" if desc else "ASC"
    return W(f"""SELECT b.item_id, t.title, round(b.b_i, 6) AS b_i, b.n FROM me_bi b
LEFT JOIN item_titles t ON b.item_id = t.item_id ORDER BY round(b.b_i, 9) {o}, b.item_id LIMIT 20""", ["item_titles"], _MOVIE_CTES)


def movie_report(spark, sf, desc):
    p = P(spark, sf)
    m = p.plain_model(1)
    counts = p.item_counts("fit").groupBy("item_id").agg(F.sum("n").alias("n"))
    rep = natural_left_join(counts, m.effect_table(0))
    rep = rep.join(p.item_titles, "item_id", "left")
    key = F.round("b_i", 9)   # computed floats: order on 9 decimals, then the id
    first = key.desc() if desc else key.asc()
    return pr.top_n(rep, [first, F.col("item_id")], 20).select("item_id", "title", _r6("b_i").alias("b_i"), "n")


query("best_items", _items_sql(True))(lambda spark, sf: movie_report(spark, sf, True))
query("worst_items", _items_sql(False))(lambda spark, sf: movie_report(spark, sf, False))


@query("largest_residuals", W("""SELECT user_id, item_id, title, round(residual, 6) AS residual FROM (
  SELECT t.user_id, t.item_id, t.title, t.ts, t.rating - (m.mu + b.b_i) AS residual
  FROM tune_rows t CROSS JOIN me_mu m LEFT JOIN me_bi b ON t.item_id = b.item_id)
ORDER BY round(abs(residual), 9) DESC, item_id, user_id, ts LIMIT 20""", ["tune_rows"], _MOVIE_CTES))
def largest_residuals(spark, sf):
    """The 20 test rows the movie-effect model misses most."""
    p = P(spark, sf)
    pred = p.plain_model(1).predict(p.tune_rows, upto=1).withColumn("residual", F.col("rating") - F.col("pred"))
    return pr.top_n(pred, [F.round(F.abs("residual"), 9).desc(), F.col("item_id"), F.col("user_id"),
                           F.col("ts")], 20) \
        .select("user_id", "item_id", "title", _r6("residual").alias("residual"))


@query("dataset_sizes", W(" UNION ALL ".join(
    f"SELECT '{d}' AS dataset, count(*) AS n_rows, CAST(9 AS BIGINT) AS n_cols, format('{{:,}}', count(*)) AS n_rows_fmt FROM {d}"
    for d in ["known", "validation", "fit_rows", "tune_rows"]), ["known", "validation", "fit_rows", "tune_rows"]))
def dataset_sizes(spark, sf):
    p = P(spark, sf)
    return pr.dataset_sizes({"known": p.known, "validation": p.validation, "fit_rows": p.fit_rows,
                             "tune_rows": p.tune_rows})
