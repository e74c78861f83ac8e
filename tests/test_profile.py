"""Profiling and chart data: genre breakdowns, histograms, box plots, trend."""

import math

from pyspark.sql import functions as F

from ratecraft.operators import profile as pr
from ratecraft.operators.chartdata import box_stats, histogram, period_trend
from ratecraft.plans.pipeline import Pipeline
from conftest import SF


def test_genre_profile_matches_direct_explode(spark):
    known = Pipeline.of(spark, SF).known
    a = {r.genre: r.count_ratings for r in pr.genre_profile(known).collect()}
    b = {r.genre: r.count_ratings for r in pr.genre_counts_direct(known).collect()}
    assert a == b
    # means are unweighted means of genre-string means
    per = {r.genres: r.mean for r in pr.mean_by(known, "genres").collect()}
    g0 = next(iter(a))
    means = [m for s, m in per.items() if g0 in s.split("|")]
    got = {r.genre: r.mean_rating for r in pr.genre_profile(known).collect()}[g0]
    assert math.isclose(got, sum(means) / len(means), rel_tol=1e-12)


def test_histogram_counts_all_rows(spark):
    df = spark.range(1000).select((F.col("id") % 97).cast("double").alias("x"))
    h = histogram(df, "x", 10).collect()
    assert sum(r["count"] for r in h) == 1000
    assert max(r.bin for r in h) == 9 and min(r.bin for r in h) == 0


def test_box_stats(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 100]], "g string, v double")
    r = box_stats(df, "g", "v").first()
    assert (r.q1, r.median, r.q3) == (2.0, 3.0, 4.0)
    assert r.whisker_high == 4.0 and r.n_outliers == 1


def test_period_trend(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(10)], "idx int, v double")
    t = {r.idx: r.trend for r in period_trend(df, "idx", "v", 2).collect()}
    assert t[5] == 5.0 and t[0] == 1.0   # (0+1+2)/3 at the edge


def test_duplicated_rows(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x"), (4, "x")], "item_id long, title string")
    assert sorted(r.item_id for r in pr.duplicated_rows(df, "title", "item_id").collect()) == [3, 4]


def test_null_titles_repeat_and_join(spark):
    from ratecraft.operators import profile as pr
    from ratecraft.operators.joins import natural_left_join
    df = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "a"), (5, "b")], "item_id long, title string")
    assert sorted(r.item_id for r in pr.duplicated_rows(df, "title", "item_id").collect()) == [2, 4]
    assert {r.repeated: r.n for r in pr.duplicate_counts(df, "title", "item_id").collect()} == {False: 3, True: 2}
    right = spark.createDataFrame([(None, 1), ("a", 2)], "title string, v int")
    assert {r.item_id: r.v for r in natural_left_join(df, right).collect()} == {1: 1, 2: 1, 3: 2, 4: 2, 5: None}


def test_summary_of_every_kind_of_column_in_one_scan(spark):
    from ratecraft.operators import profile as pr
    df = spark.createDataFrame([(1, 1.0, "2000-01-01"), (2, None, "2000-01-03"), (3, 4.0, None)], "a long, b double, d string")
    df = df.withColumn("d", F.col("d").cast("date"))
    out = pr.column_summary(df, ["a", "b", "d"])
    rows = {r.column: r for r in out.collect()}
    assert (rows["a"].median, rows["b"].n_na, rows["d"].n_na, rows["d"].max - rows["d"].min) == (2.0, 1, 1, 2.0)


def test_corrections_use_no_loop_join(spark):
    from conftest import SF
    from ratecraft.operators.prepare import correct_ids, drop_ids
    from ratecraft.plans.pipeline import Pipeline
    p = Pipeline.of(spark, SF)
    for df in (correct_ids(p.known_raw, p.corrections), p.item_titles, drop_ids(p.known_raw, p.corrections)):
        assert "NestedLoop" not in df._jdf.queryExecution().executedPlan().toString()
