"""Scalar features: release year, epoch conversion, rounding to week/month."""

import datetime as dt

from pyspark.sql import functions as F

from ratecraft.functions import features as ft
from ratecraft.functions.stats import n_distinct
from conftest import SF01


def test_release_year_nulls(spark):
    df = spark.createDataFrame([("Toy Story (1995)",), ("No year here",), ("A (1999) ",), ("untitled",)], "title string")
    got = [r[0] for r in df.select(ft.release_year("title")).collect()]
    assert got == [1995, None, None, None]
    assert [r[0] for r in df.select(ft.title_has_year("title")).collect()] == [True, False, False, False]


def test_epoch_roundtrip_is_timezone_free(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        r = spark.range(1).select(ft.from_epoch_seconds(F.lit(796694400)).alias("t")) \
            .select("t", ft.epoch_seconds("t").alias("s")).first()
        assert r.t == dt.datetime(1995, 4, 1) and r.s == 796694400
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def _check_rounding(df, unit, days_lo, days_hi):
    out = df.select("ts", ft.round_to_period("ts", unit).alias("p")).collect()
    assert out
    for r in out:
        p = dt.datetime.combine(r.p, dt.time())
        if unit == "month":
            assert r.p.day == 1
        else:
            assert r.p.weekday() == 6  # Sunday
        # within half a period of the input
        assert abs((r.ts - p).total_seconds()) <= days_hi * 86400 / 2


def test_round_to_period_properties(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet").select("ts")
    _check_rounding(ev, "month", 28, 31)
    _check_rounding(ev, "week", 7, 7)


def test_round_ties_go_up(spark):
    df = spark.createDataFrame([(dt.datetime(2001, 1, 16, 12, 0),), (dt.datetime(2001, 1, 4, 12, 0),)], "ts timestamp_ntz")
    got = [r[0] for r in df.select(ft.round_to_period("ts", "month")).collect()]
    # Jan has 31 days: 16th noon is exactly half way -> next month
    assert got == [dt.date(2001, 2, 1), dt.date(2001, 1, 1)]
    wk = [r[0] for r in df.select(ft.round_to_period("ts", "week")).collect()]
    assert wk[1] == dt.date(2001, 1, 7)  # Thursday noon: 4.5 days past Sunday, 2.5 ahead


def test_n_distinct_counts_null(spark):
    df = spark.createDataFrame([(1,), (None,), (1,), (2,)], "x int")
    assert df.select(n_distinct("x")).first()[0] == 3


def test_genres(spark):
    df = spark.createDataFrame([("Action|Comedy",), ("Drama",)], "genres string")
    assert [r[0] for r in df.select(ft.first_genre("genres")).collect()] == ["Action", "Drama"]
