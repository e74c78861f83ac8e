"""Additive bias-effect rating models: rating ~ mu + b_item + b_user + ...

Effects are fitted one after another on what the earlier ones leave. The
rows joined to the first effect's sums are written once; the second effect is
an aggregate of that table and is joined to it once, whatever the number of
later effects, which follow from marginal sums and pair counts.

A null rating makes its mean and its effects null (``drop_null=True`` fits
without such rows).

Shrinkage constants are *columns*: one fit computes an effect for every
lambda of a grid in the same aggregate (``sum(resid_j) / (n + lambda_j)``),
so a grid of 41 lambdas is one job per effect, not 41 jobs. With ``by``
(e.g. a fold key) many independent models are fitted in the same jobs.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft.functions.stats import strict_mean, strict_rmse_aggs
from ratecraft.operators.joins import keyed_join
from ratecraft.session import materialize


@dataclass(frozen=True)
class Effect:
    """One additive effect: ``name`` is fitted per value of ``key``.

    stat: "sum" gives sum(resid)/(n + lambda); "mean" gives
    mean(resid)/(n + lambda), the form used for the genre effect of the
    analysis being reproduced (it divides by n twice). Without a lambda
    both are the plain mean.
    null_safe: the key may be null and null forms its own group.
    """
    name: str
    key: str
    stat: str = "sum"
    null_safe: bool = False


def standard_effects(item="item_id", user="user_id", year="release_year",
                     date="rating_date", genres="genres", genre_stat="mean",
                     upto: int = 5) -> list[Effect]:
    """The five effects (item, user, release year, rating month, genre string)."""
    effs = [
        Effect("b_i", item),
        Effect("b_u", user),
        Effect("b_y", year, null_safe=True),
        Effect("b_t", date, null_safe=True),
        Effect("b_g", genres, stat=genre_stat, null_safe=True),
    ]
    return effs[:upto]


def _strict_sum(x: Column) -> Column:
    """Sum that is null as soon as one term is null."""
    return F.when(F.count(x) == F.count(F.lit(1)), F.sum(x))


class EffectModel:
    """Fitted mu and effect tables for one or many shrinkage constants.

    ``slots`` are the lambdas: ``None`` (plain means), a float, or the name
    of a column carried in from a one-row lambda table.

    The first effect is stored as its sufficient statistics (sum of
    residuals ``__S`` and count ``__n`` per key): every lambda's value is
    ``S / (n + lambda)``, computed where it is used. Rows joined to it carry
    two numbers instead of one per lambda, which keeps the big joins narrow.
    Later effects depend on the earlier ones per lambda and are stored as
    one column per lambda (``{name}__{j}``).
    """

    def __init__(self, mu: DataFrame, effects: list[Effect], tables: list[DataFrame],
                 slots: list, by: tuple[str, ...], rating: str, lambda_table: DataFrame | None):
        self.mu, self.effects, self.tables = mu, effects, tables
        self.slots, self.by, self.rating = slots, by, rating
        self.lambda_table = lambda_table

    def _lam(self, j) -> Column:
        s = self.slots[j]
        return F.col(s) if isinstance(s, str) else F.lit(s)

    def _first_value(self, j, S="__S0", n="__n0") -> Column:
        e = self.effects[0]
        S, n = F.col(S), F.col(n)
        if self.slots[j] is None:
            return S / n
        if e.stat == "mean":
            return (S / n) / (n + self._lam(j))
        return S / (n + self._lam(j))

    def value(self, idx: int, j: int) -> Column:
        """Effect ``idx`` for slot ``j`` on rows that went through ``attach``."""
        return self._first_value(j) if idx == 0 else F.col(f"{self.effects[idx].name}__{j}")

    # -- effect tables -------------------------------------------------
    def effect_table(self, idx: int, slot: int = 0) -> DataFrame:
        """Effect ``idx`` for one slot with the column named after the effect."""
        e = self.effects[idx]
        t = self.tables[idx]
        if idx == 0:
            if self.lambda_table is not None:
                t = t.crossJoin(F.broadcast(self.lambda_table))
            return t.select(*self.by, e.key, self._first_value(slot, "__S", "__n").alias(e.name))
        return t.select(*self.by, e.key, F.col(f"{e.name}__{slot}").alias(e.name))

    # -- joins -----------------------------------------------------------
    def attach(self, df: DataFrame, upto: int, with_mu: bool = True) -> DataFrame:
        """Join mu and effects ``0..upto-1`` (with lambda columns) onto ``df``."""
        out = df
        if with_mu:
            out = out.join(F.broadcast(self.mu), list(self.by), "left") if self.by else \
                out.crossJoin(F.broadcast(self.mu))
        if self.lambda_table is not None and "__lam0" not in out.columns:
            out = out.crossJoin(F.broadcast(self.lambda_table))
        for idx in range(upto):
            e, tab = self.effects[idx], self.tables[idx]
            if idx == 0:
                tab = tab.withColumnsRenamed({"__S": "__S0", "__n": "__n0"})
            out = keyed_join(out, tab, [*self.by, e.key], "left",
                             null_safe=[e.key] if e.null_safe else [])
        return out

    def _pred_cols(self, upto: int) -> dict:
        L = len(self.slots)
        preds = {}
        for j in range(L):
            p = F.col("mu")
            for idx in range(upto):
                p = p + self.value(idx, j)
            preds[f"pred__{j}"] = p
        return preds

    # -- prediction ----------------------------------------------------
    def predict(self, test: DataFrame, upto: int | None = None, slot: int = 0,
                keep_parts: bool = False) -> DataFrame:
        """Test rows with ``pred`` (and, with keep_parts, each effect) for one slot."""
        upto = len(self.effects) if upto is None else upto
        t = self.attach(test, upto)
        cols = {"pred": self._pred_cols(upto)[f"pred__{slot}"]}
        if keep_parts:
            for idx in range(upto):
                cols[self.effects[idx].name] = self.value(idx, slot)
        helper = ["mu", "__S0", "__n0", "__lam0"] + [f"{e.name}__{j}" for e in self.effects
                                                      for j in range(len(self.slots))]
        return t.withColumns(cols).drop(*[c for c in helper if c in t.columns])

    def rmse(self, test: DataFrame, upto: int | None = None) -> DataFrame:
        """Strict RMSE per ``by`` group and lambda: (by..., slot, lambda, rmse, n, n_unscored)."""
        return self._scores(test, [len(self.effects) if upto is None else upto]).drop("upto")

    def rmse_prefixes(self, test: DataFrame) -> DataFrame:
        """``rmse`` of the first 0, 1, ... effects, all from one pass: (by..., upto, slot, lambda, rmse, n, n_unscored)."""
        return self._scores(test, list(range(len(self.effects) + 1)))

    def _scores(self, test: DataFrame, prefixes: list[int]) -> DataFrame:
        t = self.attach(test, max(prefixes))
        aggs, structs = [], []
        for k in prefixes:
            preds = self._pred_cols(k)
            for j, s in enumerate(self.slots):
                at = f"p{k}s{j}_"
                aggs += strict_rmse_aggs(F.col(self.rating), preds[f"pred__{j}"], prefix=at)
                lam = (F.lit(None).cast("double") if s is None else
                       F.col(s).cast("double") if isinstance(s, str) else F.lit(float(s)))
                structs.append(F.struct(F.lit(k).alias("upto"), F.lit(j).alias("slot"), lam.alias("lambda"), F.col(f"{at}rmse").alias("rmse"),
                                        F.col(f"{at}n").alias("n"), F.col(f"{at}n_unscored").alias("n_unscored")))
        g = t.groupBy(*self.by).agg(*aggs)
        if self.lambda_table is not None:
            g = g.crossJoin(F.broadcast(self.lambda_table))
        return g.select(*self.by, F.inline(F.array(*structs)))


# Lambdas fitted per pass. Each lambda adds a column to every row of the
# later stages; past about fifteen the generated code of a stage grows beyond
# what the JVM compiles, so a grid is fitted in chunks that share mu, the
# first effect and the joined training rows (all lambda-free).
LAMBDA_CHUNK = 14


def fit_effects(train: DataFrame, effects: Sequence[Effect], lambdas=None,
                rating: str = "rating", by: Sequence[str] = (), persist: bool = True,
                drop_null: bool = False):
    """Fit mu and the effects in order, for one or many shrinkage constants.

    lambdas: None (plain means), a float, a list of floats (one slot each),
    or a one-row DataFrame with a ``lambda`` column (a tuned value that is
    never collected to the driver). A list longer than ``LAMBDA_CHUNK``
    returns a ``ChunkedEffectModel``.

    persist: write mu, every fitted effect table (one row per key and
    ``by`` group, small next to the ratings) and the training rows joined to
    the first effect's statistics to the shared checkpoint folder. Each
    stage then scans those tables, which keeps plans linear (stage k would
    otherwise embed stage k-1 twice) and the row-side join narrow, and gives
    the planner exact sizes for its broadcast decision.
    """
    by = tuple(by)
    effects = list(effects)
    keep = (lambda df, name: materialize(df, name)) if persist else (lambda df, name: df)
    lambda_table = None
    if lambdas is None or isinstance(lambdas, (int, float)):
        slots = [None if lambdas is None else float(lambdas)]
    elif isinstance(lambdas, DataFrame):
        lambda_table = keep(lambdas.select(F.col("lambda").cast("double").alias("__lam0")), "lambda")
        slots = ["__lam0"]
    else:
        slots = [float(x) for x in lambdas]

    if drop_null:
        train = train.filter(F.col(rating).isNotNull())
    rows = train.select(*by, rating, *dict.fromkeys(e.key for e in effects))
    mu = keep(rows.groupBy(*by).agg(strict_mean(rating).alias("mu")), "mu")
    first_tables, base = [], None
    if effects:
        e0 = effects[0]
        r0 = F.col(rating) - F.col("mu")
        rows_mu = rows.join(F.broadcast(mu), list(by), "inner") if by else rows.crossJoin(F.broadcast(mu))
        stats = rows_mu.groupBy(*by, e0.key).agg(_strict_sum(r0).alias("__S"), F.count(F.lit(1)).alias("__n"))
        first_tables = [keep(stats, e0.name)]
        if len(effects) > 1:
            shared = EffectModel(mu, effects, first_tables, slots[:1], by, rating, lambda_table)
            # training rows + first-effect statistics (narrow), scanned by every later stage
            base = materialize(shared.attach(rows, 1), "rows", rebalance=True) if persist else \
                shared.attach(rows, 1)
    chunks = [slots[i:i + LAMBDA_CHUNK] for i in range(0, len(slots), LAMBDA_CHUNK)]
    models = [EffectModel(mu, effects, list(first_tables), c, by, rating, lambda_table) for c in chunks]
    if len(models) == 1:
        _fit_later(models[0], base, keep)
        return models[0]
    # Chunks are independent: submit their jobs from concurrent driver
    # threads so the scheduler interleaves their tasks.
    with ThreadPoolExecutor(max_workers=len(models)) as pool:
        list(pool.map(lambda m: _fit_later(m, base, keep), models))
    return ChunkedEffectModel(models)


def _fit_later(model: EffectModel, base: DataFrame | None, keep) -> None:
    """Fit effects 1.. of ``model`` on ``base`` (rows joined to mu and effect 0).

    The second effect is one aggregate of ``base``. Its table is joined to the
    rows once; one aggregate by ``GROUPING SETS`` then sums what is left of the
    rating by the key of every later effect, and another one, without a join,
    counts the rows of every pair of later keys. The later effects are taken
    off each other on those small tables:
    S'(b) = S(b) - sum over a of n(a, b) * effect(a).
    """
    effects, by, slots = model.effects, list(model.by), range(len(model.slots))
    if len(effects) < 2:
        return

    def left_of(idx, j):
        r = F.col(model.rating) - F.col("mu")
        for m in range(idx):
            r = r - model.value(m, j)
        return r

    def shrunk(sums: DataFrame, e: Effect) -> DataFrame:
        """The effect table of ``e`` from its sums ``__s{j}`` and counts ``__n``."""
        if model.lambda_table is not None:
            sums = sums.crossJoin(F.broadcast(model.lambda_table))
        vals, n = [], F.col("__n")
        for j in slots:
            s = F.col(f"__s{j}")
            if model.slots[j] is None:
                v = s / n
            elif e.stat == "mean":
                v = (s / n) / (n + model._lam(j))
            else:
                v = s / (n + model._lam(j))
            vals.append(v.alias(f"{e.name}__{j}"))
        return sums.select(*by, e.key, *vals)

    second, later = effects[1], effects[2:]
    keys = [e.key for e in later]
    # grouping_id has a bit for each of (by..., keys...) that is not grouped by
    grouped = lambda *own: sum(1 << (len(keys) - 1 - m) for m in range(len(keys)) if m not in own)

    def count_pairs():
        if len(later) < 2:
            return None
        return keep(base.groupingSets([[*by, a, b] for a, b in combinations(keys, 2)], *by, *keys)
                    .agg(F.grouping_id().alias("__g"), F.count(F.lit(1)).alias("__w")), "pairs")

    with ThreadPoolExecutor(max_workers=1) as pool:
        pairs = pool.submit(count_pairs)         # needs no effect: runs beside the second effect
        sums = base.groupBy(*by, second.key).agg(F.count(F.lit(1)).alias("__n"), *[_strict_sum(left_of(1, j)).alias(f"__s{j}") for j in slots])
        model.tables.append(keep(shrunk(sums, second), second.name))
        if not later:
            return
        known = keyed_join(base, model.tables[1], [*by, second.key], "left", null_safe=[second.key] if second.null_safe else [])
        known = known.select(*by, *keys, *[left_of(2, j).alias(f"__r{j}") for j in slots])
        marginal = known.groupingSets([[*by, k] for k in keys], *by, *keys).agg(
            F.grouping_id().alias("__g"), F.count(F.lit(1)).alias("__n"), *[_strict_sum(F.col(f"__r{j}")).alias(f"__s{j}") for j in slots])
        marginal = keep(marginal, "marginals")
        pairs = pairs.result()
    found: list[DataFrame] = []
    for i, e in enumerate(later):
        t = marginal.filter(F.col("__g") == grouped(i)).select(*by, e.key, "__n", *[f"__s{j}" for j in slots])
        for m in range(i):
            p = later[m]
            w = keyed_join(pairs.filter(F.col("__g") == grouped(m, i)).select(*by, p.key, e.key, "__w"), found[m], [*by, p.key],
                           "left", null_safe=[p.key] if p.null_safe else [])
            off = w.groupBy(*by, e.key).agg(*[_strict_sum(F.col("__w") * F.col(f"{p.name}__{j}")).alias(f"__o{j}") for j in slots])
            t = keyed_join(t, off, [*by, e.key], "left", null_safe=[e.key])
            t = t.select(*by, e.key, "__n", *[(F.col(f"__s{j}") - F.col(f"__o{j}")).alias(f"__s{j}") for j in slots])
        found.append(shrunk(t, e))
    # all later effects in one job and one table, a row for each effect and key
    kinds = dict(marginal.dtypes)
    rows = None
    for i, (e, t) in enumerate(zip(later, found)):
        own = t.select(F.lit(i).alias("__e"), *by, *[(F.col(k) if k == e.key else F.lit(None).cast(kinds[k])).alias(k) for k in keys],
                       *[F.col(f"{e.name}__{j}").alias(f"__v{j}") for j in slots])
        rows = own if rows is None else rows.unionByName(own)
    rows = keep(rows, "later-effects")
    for i, e in enumerate(later):
        model.tables.append(rows.filter(F.col("__e") == i).select(*by, e.key, *[F.col(f"__v{j}").alias(f"{e.name}__{j}") for j in slots]))


class ChunkedEffectModel:
    """A lambda grid fitted in chunks, with the methods of ``EffectModel``."""

    def __init__(self, models: list[EffectModel]):
        self.models = models
        self.effects, self.by, self.mu = models[0].effects, models[0].by, models[0].mu
        self.slots = [s for m in models for s in m.slots]

    def _of(self, slot: int) -> tuple[EffectModel, int]:
        for m in self.models:
            if slot < len(m.slots):
                return m, slot
            slot -= len(m.slots)
        raise IndexError("no such lambda slot")

    def effect_table(self, idx: int, slot: int = 0) -> DataFrame:
        m, j = self._of(slot)
        return m.effect_table(idx, j)

    def predict(self, test: DataFrame, upto: int | None = None, slot: int = 0, keep_parts: bool = False) -> DataFrame:
        m, j = self._of(slot)
        return m.predict(test, upto, j, keep_parts)

    def rmse(self, test: DataFrame, upto: int | None = None) -> DataFrame:
        out, offset = None, 0
        for m in self.models:
            r = m.rmse(test, upto).withColumn("slot", F.col("slot") + offset)
            offset += len(m.slots)
            out = r if out is None else out.unionByName(r)
        return out

