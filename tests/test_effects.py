"""Effect models: shrinkage properties, strict RMSE, grid vs single fits."""

import math

import pytest
from pyspark.sql import functions as F

from ratecraft.operators.effects import Effect, fit_effects, standard_effects
from ratecraft.plans.pipeline import Pipeline
from conftest import SF


@pytest.fixture(scope="module")
def pipe(spark):
    return Pipeline.of(spark, SF)


def _tab(m, i):
    e = m.effects[i]
    return {tuple(r)[:-1]: r[-1] for r in m.effect_table(i).collect()}


def test_lambda_zero_equals_plain_except_genre(pipe):
    plain = fit_effects(pipe.fit_rows, standard_effects(), None)
    zero = fit_effects(pipe.fit_rows, standard_effects(), 0.0)
    for i in range(4):
        a, b = _tab(plain, i), _tab(zero, i)
        assert a.keys() == b.keys()
        assert all(math.isclose(a[k], b[k], abs_tol=1e-9) for k in a)
    a, b = _tab(plain, 4), _tab(zero, 4)
    assert any(not math.isclose(a[k], b[k], abs_tol=1e-9) for k in a)   # genre divides by n again


def test_item_effect_shrinks(pipe):
    prev = None
    for lam in [0.0, 1.0, 5.0, 25.0]:
        t = _tab(fit_effects(pipe.fit_rows, standard_effects(upto=1), lam), 0)
        if prev is not None:
            assert all(abs(t[k]) <= abs(prev[k]) + 1e-12 for k in t)
        prev = t


def test_grid_equals_single_fits(pipe):
    lams = [0.0, 2.5, 7.0]
    grid = fit_effects(pipe.fit_rows, standard_effects(), lams).rmse(pipe.tune_rows)
    got = {r["lambda"]: r.rmse for r in grid.collect()}
    for lam in lams:
        one = fit_effects(pipe.fit_rows, standard_effects(), lam).rmse(pipe.tune_rows).first().rmse
        assert math.isclose(got[lam], one, rel_tol=1e-12)


def test_chunked_grid_covers_all_lambdas(pipe):
    lams = [i * 0.5 for i in range(20)]     # more than one chunk
    g = fit_effects(pipe.fit_rows, standard_effects(upto=2), lams).rmse(pipe.tune_rows).collect()
    assert sorted(r["lambda"] for r in g) == lams
    one = fit_effects(pipe.fit_rows, standard_effects(upto=2), lams[-1]).rmse(pipe.tune_rows).first().rmse
    assert math.isclose({r["lambda"]: r.rmse for r in g}[lams[-1]], one, rel_tol=1e-12)


def test_strict_rmse_null_for_unseen_key(spark):
    train = spark.createDataFrame([(1, "a", 3.0), (2, "a", 4.0)], "item_id long, m string, rating double")
    test = spark.createDataFrame([(1, "a", 3.0), (2, "b", 5.0)], "item_id long, m string, rating double")
    effs = [Effect("b_i", "item_id"), Effect("b_t", "m")]
    r = fit_effects(train, effs, None).rmse(test).first()
    assert r.rmse is None and r.n == 2 and r.n_unscored == 1


def test_null_key_forms_its_own_group(spark):
    train = spark.createDataFrame([(None, 2.0), (None, 4.0), (1, 5.0)], "y int, rating double")
    m = fit_effects(train, [Effect("b_y", "y", null_safe=True)], None)
    test = spark.createDataFrame([(None, 3.0)], "y int, rating double")
    pred = m.predict(test).first().pred
    assert math.isclose(pred, 3.0, rel_tol=1e-12)   # mu 11/3 plus the null group's -2/3


def test_planted_structure_beats_naive(spark):
    rows = [(u, i, min(5.0, max(0.5, 3.0 + (i % 3) - 1 + (u % 2) * 0.5))) for u in range(40) for i in range(30)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    tr, te = df.filter((F.col("user_id") + F.col("item_id")) % 5 != 0), df.filter((F.col("user_id") + F.col("item_id")) % 5 == 0)
    naive = fit_effects(tr, [], None).rmse(te).first().rmse
    two = fit_effects(tr, standard_effects(upto=2), None).rmse(te).first().rmse
    assert two < 0.2 * naive


def test_folds_as_key_equal_per_fold_loop(spark):
    """All folds in one fit (fold key h) equal k separate guarded splits and fits."""
    from ratecraft.operators.split import expand_folds, guarded_split
    p = Pipeline.of(spark, SF)
    data = p.fit_rows
    k, lams = 3, [0.0, 5.0]
    fold = F.col("bucket") % k
    train, test = expand_folds(data, fold, k)
    got = {(r.h, r["lambda"]): (r.rmse, r.n) for r in
           fit_effects(train, standard_effects(), lams, by=("h",)).rmse(test).collect()}
    for h in range(k):
        tr, te = guarded_split(data, fold == h)
        for lam in lams:
            one = fit_effects(tr, standard_effects(), lam).rmse(te).first()
            g = got[(h, lam)]
            assert g[1] == one.n
            assert (g[0] is None and one.rmse is None) or math.isclose(g[0], one.rmse, rel_tol=1e-9)


def test_null_ratings_are_strict_or_dropped(spark):
    from ratecraft.operators.effects import Effect, fit_effects
    df = spark.createDataFrame([(1, 4.0), (1, None), (2, 2.0)], "item_id long, rating double")
    strict = fit_effects(df, [Effect("b_i", "item_id")])
    assert {r.b_i for r in strict.effect_table(0).collect()} == {None}
    dropped = fit_effects(df, [Effect("b_i", "item_id")], drop_null=True)
    assert {r.item_id: r.b_i for r in dropped.effect_table(0).collect()} == {1: 1.0, 2: -1.0}


def test_any_number_of_lambdas_has_one_api(spark):
    from ratecraft.operators.effects import LAMBDA_CHUNK, fit_effects, standard_effects
    rows = [(u, i, float((u * i) % 5 + 1)) for u in range(6) for i in range(7)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    effects = standard_effects(upto=2)
    lambdas = [0.5 * j for j in range(LAMBDA_CHUNK + 2)]
    many = fit_effects(df, effects, lambdas)
    for slot in (0, LAMBDA_CHUNK + 1):
        one = fit_effects(df, effects, lambdas[slot])
        for a, b in ((many.effect_table(1, slot), one.effect_table(1)), (many.predict(df, slot=slot).select("pred"), one.predict(df).select("pred"))):
            key = lambda t: sorted(tuple(round(x, 9) for x in r) for r in t.collect())
            assert key(a) == key(b)


def test_hot_item_is_split(spark):
    """An item with a third of all rows: the row-side join is an equi-join that AQE splits, and the sums are exact."""
    from ratecraft.operators.effects import Effect, fit_effects
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("item_id"),
                                    (F.col("id") % 50).alias("user_id"), (F.col("id") % 5).cast("double").alias("rating"))
    m = fit_effects(df, [Effect("b_i", "item_id"), Effect("b_u", "user_id")], 1.0)
    mu = 2.0
    hot = m.effect_table(0).filter("item_id = 0").first().b_i
    assert abs(hot - sum((i % 5) - mu for i in range(0, 60_000, 3)) / 20_001) < 1e-9
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = m.attach(df, 1)
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _direct(rows, keys, stats, lam):
    """Effects fitted the plain way, row by row (null keys are a group of their own)."""
    mu = sum(r["rating"] for r in rows) / len(rows)
    left, out = [r["rating"] - mu for r in rows], []
    for key, stat in zip(keys, stats):
        groups = {}
        for r, x in zip(rows, left):
            groups.setdefault(r[key], []).append(x)
        eff = {k: (sum(v) / len(v) if stat == "mean" or lam is None else sum(v)) / (1 if lam is None else len(v) + lam) for k, v in groups.items()}
        left = [x - eff[r[key]] for r, x in zip(rows, left)]
        out.append(eff)
    return mu, out


@pytest.mark.parametrize("lam", [None, 0.0, 3.5])
@pytest.mark.parametrize("n_later", [0, 1, 2, 4])
def test_marginal_fit_equals_the_direct_fit(spark, lam, n_later):
    import random
    rng = random.Random(n_later)
    keys = ["item", "user"] + [f"k{i}" for i in range(n_later)]
    rows = [dict(zip(keys, [rng.randrange(12), rng.randrange(20)] + [rng.choice([None, 0, 1, 2, 3]) for _ in range(n_later)]), rating=rng.randrange(1, 11) / 2)
            for _ in range(400)]
    df = spark.createDataFrame([tuple(r[c] for c in (*keys, "rating")) for r in rows], ", ".join(f"{k} int" for k in keys) + ", rating double")
    effects = [Effect(f"e{i}", k, stat="mean" if i == 4 else "sum", null_safe=i > 1) for i, k in enumerate(keys)]
    model = fit_effects(df, effects, lam)
    _, want = _direct(rows, keys, [e.stat for e in effects], lam)
    for i, e in enumerate(effects):
        got = {r[e.key]: r[e.name] for r in model.effect_table(i).collect()}
        assert got.keys() == want[i].keys() and all(math.isclose(got[k], want[i][k], abs_tol=1e-9) for k in got)


def test_marginal_fit_by_group_equals_separate_fits(spark, pipe):
    df = pipe.fit_rows.withColumn("h", F.col("bucket") % 2)
    both = fit_effects(df, standard_effects(), 2.0, by=["h"])
    for h in (0, 1):
        one = fit_effects(df.filter(F.col("h") == h), standard_effects(), 2.0)
        for i in range(5):
            e = one.effects[i]
            a = {r[e.key]: r[e.name] for r in both.effect_table(i).filter(F.col("h") == h).collect()}
            b = {r[e.key]: r[e.name] for r in one.effect_table(i).collect()}
            assert a.keys() == b.keys() and all(math.isclose(a[k], b[k], abs_tol=1e-9) for k in a)


def test_null_rating_spreads_as_it_does_row_by_row(spark):
    """A null rating makes mu and with it every effect null; with drop_null it is left out."""
    rows = [(1, 1, 1, 2.0), (1, 2, 1, 4.0), (2, 1, None, 3.0), (2, 2, 2, None)]
    df = spark.createDataFrame(rows, "item_id int, user_id int, release_year int, rating double")
    effects = standard_effects()[:3]
    strict = fit_effects(df, effects, 1.0)
    assert all(v is None for i in range(3) for v in _tab(strict, i).values())
    loose = fit_effects(df, effects, 1.0, drop_null=True)
    assert all(v is not None for i in range(3) for v in _tab(loose, i).values())


def test_prefix_scores_equal_single_scores(pipe):
    model = fit_effects(pipe.fit_rows, standard_effects(), None)
    rows = {r.upto: r for r in model.rmse_prefixes(pipe.tune_rows).collect()}
    assert sorted(rows) == list(range(6))
    for k in range(6):
        one = model.rmse(pipe.tune_rows, k).first()
        assert math.isclose(rows[k].rmse, one.rmse, rel_tol=1e-12) and (rows[k].n, rows[k].n_unscored) == (one.n, one.n_unscored)


def test_narrow_queries_have_no_join(spark):
    import __spark_entry__ as E
    for name in ("rating_distribution", "ratings_per_user", "ratings_per_item", "mean_per_month", "mean_per_user", "rating_datetime", "hist_ratings"):
        plan = E.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "Join LeftOuter" not in plan, name


def test_grid_rows_of_a_user_stand_together(spark, monkeypatch):
    """Map-side aggregates by user can combine rows only if a user's rows are written together."""
    from ratecraft.operators import grid
    from ratecraft.operators.effects import standard_effects
    plans, write = {}, grid.materialize
    monkeypatch.setattr(grid, "materialize", lambda df, name, **kw: plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString()) and write(df, name, **kw))
    df = spark.range(600).select((F.col("id") % 20).alias("item_id"), (F.col("id") % 30).alias("user_id"), (F.col("id") % 9 / 2 + 0.5).alias("rating"), F.pmod(F.xxhash64("id"), F.lit(3)).cast("int").alias("f"),
                                 (F.col("id") % 4).alias("release_year"), (F.col("id") % 5).alias("rating_date"), (F.col("id") % 2).alias("genres"))
    assert grid.fold_lambda_grid(df, F.col("f"), 3, standard_effects(), [0.0, 1.0]).count() == 6
    assert "REBALANCE_PARTITIONS_BY_COL" in plans["grid-rows"] and "user_id" in plans["grid-rows"]


def test_grid_shuffles_rows_of_users_once_and_leaves_no_tables(spark, monkeypatch):
    """Only the write of the grid's rows deals by user; the sums and joins on user go bucket by bucket, and its tables are removed."""
    import glob
    from ratecraft.operators import grid
    from ratecraft.operators.effects import standard_effects
    plans, write = {}, grid.materialize
    monkeypatch.setattr(grid, "materialize", lambda df, name, **kw: plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString()) and write(df, name, **kw))
    df = spark.range(900).select(F.when(F.col("id") % 50 != 0, F.col("id") % 20).alias("item_id"), F.when(F.col("id") % 60 != 0, F.when(F.col("id") < 400, 7).otherwise(F.col("id") % 30)).alias("user_id"),
                                 F.when(F.col("id") != 5, F.col("id") % 9 / 2 + 0.5).alias("rating"), F.pmod(F.xxhash64("id"), F.lit(3)).cast("int").alias("f"),
                                 (F.col("id") % 4).alias("release_year"), (F.col("id") % 5).alias("rating_date"), (F.col("id") % 2).alias("genres"))
    assert grid.fold_lambda_grid(df, F.col("f"), 3, standard_effects(), [0.0, 1.0]).count() == 6
    assert "hashpartitioning(user_id" in plans["grid-rows"]
    for later in ("grid-users", "grid-sums", "grid-scores"):
        assert "hashpartitioning(user_id" not in plans[later], later
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("ratecraft_")]
    at = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    assert not [p for name in ("grid-flagged", "grid-rows", "grid-users") for p in glob.glob(f"{at}/scratch-{name}-*/*.parquet")]
