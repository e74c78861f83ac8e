"""Every registered query with a SQL twin agrees with DuckDB at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return str(v)
    return v


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=lambda t: tuple(map(str, t)))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


NAMES = sorted(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_matches_duckdb(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = _rows([r.asDict() for r in df.collect()], cols)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    want = _rows([dict(zip(dcols, r)) for r in res.fetchall()], cols)
    assert got == want


def test_every_query_without_twin_is_a_model(spark):
    own = {n for n in set(E.queries()) - set(E.oracle_sql()) if not n.startswith("op") and n != "pipeline"}
    assert own == {"als_rmse", "als_grid_summary", "rf_rmse", "rf_importance"}


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["item_id", "title", "b_i", "n"]
    assert df.count() == 20
