"""Registries of Spark queries and their SQL twins."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _no_negative_zero(sql: str) -> str:
    """Wrap every ``round(...)`` as ``(round(...) + 0.0)``.

    DuckDB's round keeps the sign of a tiny negative value (-0.0) while
    Spark's decimal rounding yields 0.0; adding 0.0 maps -0.0 to 0.0.
    """
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        out.append(sql[i:j] + "(" + sql[j:j + 6] + _no_negative_zero(sql[j + 6:k]) + ") + 0.0)")
        i = k + 1


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` (with its SQL twin)."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = _no_negative_zero(sql)
        return fn
    return deco
