"""Queries: data under the charts (histograms, trend)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratecraft.functions.features import from_epoch_seconds, round_to_period
from ratecraft.operators import profile as pr
from ratecraft.operators.chartdata import histogram, period_trend
from ratecraft.plans import oracle_base as ob
from ratecraft.plans.pipeline import Pipeline
from ratecraft.plans.registry import query

W = ob.with_ctes


def _r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _hist_out(h):
    return h.select("bin", _r6("lo").alias("lo"), _r6("hi").alias("hi"), "count")


def hist_sql(src: str, x: str, bins: int, label: str | None = None) -> str:
    """SQL twin of ``histogram``: rows of ``src`` binned on expression ``x``."""
    lab = f"'{label}' AS effect, " if label else ""
    return f"""SELECT {lab}bin, round(lo + bin * ((hi - lo) / {bins}), 6) AS lo,
       round(lo + (bin + 1) * ((hi - lo) / {bins}), 6) AS hi, count(*) AS count
FROM (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((x - lo) / ((hi - lo) / {bins})), {bins - 1}) END AS INTEGER) AS bin, lo, hi
      FROM (SELECT CAST({x} AS DOUBLE) AS x FROM {src}) v
      CROSS JOIN (SELECT min(CAST({x} AS DOUBLE)) AS lo, max(CAST({x} AS DOUBLE)) AS hi FROM {src} WHERE {x} IS NOT NULL) r
      WHERE x IS NOT NULL)
GROUP BY bin, lo, hi"""


def P(spark, sf):
    return Pipeline.of(spark, sf)


@query("hist_ratings", W(hist_sql("known", "rating", 10), ["known"]))
def hist_ratings(spark, sf):
    """Ratings in 10 bins."""
    return _hist_out(histogram(P(spark, sf).known_narrow, "rating", 10))


def _per_key_hist(name, key, value_sql, bins, log10=False):
    src = f"(SELECT {key}, {value_sql} AS v FROM known GROUP BY {key})"
    x = "log10(v)" if log10 else "v"

    def fn(spark, sf):
        e = P(spark, sf).known if key == "genres" else P(spark, sf).known_narrow
        per = (e.groupBy(key).agg(F.count(F.lit(1)).alias("v")) if log10
               else e.groupBy(key).agg(F.avg("rating").alias("v")))
        return _hist_out(histogram(per, "v", bins, log10=log10))
    query(name, W(hist_sql(src, x, bins), ["known"]))(fn)


_per_key_hist("hist_item_means", "item_id", "avg(rating)", 30)
_per_key_hist("hist_user_means", "user_id", "avg(rating)", 30)
_per_key_hist("hist_genre_means", "genres", "avg(rating)", 30)
_per_key_hist("hist_item_counts_log", "item_id", "count(*)", 30, log10=True)
_per_key_hist("hist_user_counts_log", "user_id", "count(*)", 30, log10=True)

# Bins per effect histogram.
EFFECT_BINS = {"b_i": 10, "b_u": 10, "b_y": 10, "b_t": 20, "b_g": 20}


def _effects_hist_sql():
    ctes = ob.effect_chain_ctes("fit_rows", "tune_rows", 5, None, "hp_")
    parts = [hist_sql(f"hp_{n}", n, EFFECT_BINS[n], label=n) for n in EFFECT_BINS]
    return W("\nUNION ALL\n".join(parts), [], ctes)


@query("hist_effects", _effects_hist_sql())
def hist_effects(spark, sf):
    """Histograms of the five plain effects fitted on fit_rows."""
    m = P(spark, sf).plain_model()
    out = None
    for i, e in enumerate(m.effects):
        h = _hist_out(histogram(m.effect_table(i), e.name, EFFECT_BINS[e.name]))
        h = h.select(F.lit(e.name).alias("effect"), *h.columns)
        out = h if out is None else out.unionByName(h)
    return out


TREND_K = 2


@query("trend_year", W(f"""SELECT x.release_year, round(x.a, 6) AS year_mean, round(avg(y.a), 6) AS trend
FROM ix x JOIN ix y ON abs(x.release_year - y.release_year) <= {TREND_K} GROUP BY x.release_year, x.a""", [],
    [("ix", "SELECT release_year, avg(rating) AS a FROM known GROUP BY release_year", ["known"])]))
def trend_year(spark, sf):
    """Mean rating per release year with a centred 5-year moving average."""
    m = pr.mean_by(P(spark, sf).known, "release_year", name="year_mean")
    t = period_trend(m, "release_year", "year_mean", TREND_K)
    return t.select("release_year", _r6("year_mean").alias("year_mean"), _r6("trend").alias("trend"))


@query("trend_week", W(f"""SELECT x.week, round(x.a, 6) AS period_mean, round(avg(y.a), 6) AS trend
FROM ix x JOIN ix y ON abs(x.week - y.week) <= {7 * TREND_K} GROUP BY x.week, x.a""", [],
    [("ix", f"SELECT {ob.round_period_sql(ob.ts_of_epoch('ts'), 'week')} AS week, avg(rating) AS a FROM known GROUP BY 1", ["known"])]))
def trend_week(spark, sf):
    """Weekly mean rating with a centred 5-week moving average."""
    e = P(spark, sf).known_narrow.withColumn("week", round_to_period(from_epoch_seconds("ts"), "week"))
    m = pr.mean_by(e, "week", name="period_mean").withColumn("idx", F.floor((F.unix_date("week") + 4) / 7))
    t = period_trend(m, "idx", "period_mean", TREND_K)
    return t.select("week", _r6("period_mean").alias("period_mean"), _r6("trend").alias("trend"))


@query("trend_month", W(f"""SELECT x.rating_date, round(x.a, 6) AS period_mean, round(avg(y.a), 6) AS trend
FROM ix x JOIN ix y ON abs(x.idx - y.idx) <= {TREND_K} GROUP BY x.rating_date, x.a""", [],
    [("ix", """SELECT rating_date, avg(rating) AS a, year(rating_date) * 12 + month(rating_date) AS idx
FROM known GROUP BY rating_date""", ["known"])]))
def trend_month(spark, sf):
    """Monthly mean rating with a centred 5-month moving average."""
    m = pr.mean_by(P(spark, sf).known_narrow, "rating_date", name="period_mean")
    m = m.withColumn("idx", F.year("rating_date") * 12 + F.month("rating_date"))
    t = period_trend(m, "idx", "period_mean", TREND_K)
    return t.select("rating_date", _r6("period_mean").alias("period_mean"), _r6("trend").alias("trend"))
