"""SQL building blocks for the DuckDB twins of the queries.

Each twin recomputes everything from the driver tables with plain SQL,
written the straightforward way (effects re-joined from scratch, semi
joins as IN lists), so it checks the Spark plans rather than mirroring them.
"""

from __future__ import annotations

# Fixed values shared with ratecraft.plans.pipeline.
LAMBDAS = [i * 0.25 for i in range(41)]
N_FOLDS = 8

RY = r"CAST(NULLIF(regexp_extract({t}, '\((\d{{4}})\)$', 1), '') AS INTEGER)"


def release_year_sql(title: str = "title") -> str:
    return RY.format(t=title)


def ts_of_epoch(ts: str) -> str:
    return f"make_timestamp(CAST({ts} AS BIGINT) * 1000000)"


def round_period_sql(t: str, unit: str) -> str:
    """Nearest period start (ties up) of timestamp expression ``t``, as DATE."""
    if unit == "month":
        fl = f"date_trunc('month', {t})"
        ce = f"({fl} + INTERVAL 1 MONTH)"
    elif unit == "week":
        fl = f"(date_trunc('week', {t} + INTERVAL 1 DAY) - INTERVAL 1 DAY)"
        ce = f"({fl} + INTERVAL 7 DAY)"
    else:
        raise ValueError(unit)
    return (f"CAST(CASE WHEN epoch({t}) - epoch({fl}) >= epoch({ce}) - epoch({t}) "
            f"THEN {ce} ELSE {fl} END AS DATE)")


CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, sql: str, deps: list[str] | None = None) -> None:
    CTES[name] = (sql, deps or [])


def with_ctes(body: str, needed: list[str], extra: list[tuple[str, str, list[str]]] = ()) -> str:
    """``WITH`` clause holding ``needed`` CTEs (and their deps), then ``body``."""
    local = {n: (s, d) for n, s, d in extra}
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        sql, deps = local.get(n) or CTES[n]
        for d in deps:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    for n, _, _ in extra:
        visit(n)
    parts = [f"{n} AS (\n{(local.get(n) or CTES[n])[0]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body


# --- fixtures -----------------------------------------------------------
cte("ratings", """SELECT o_custkey AS user_id, l_partkey AS item_id, ceil(l_quantity/5)/2 AS rating,
       CAST(epoch(l_shipdate) AS BIGINT) AS ts,
       (l_orderkey*7 + l_linenumber*13 + l_partkey) % 10 AS bucket
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
cte("ratings_sparse", "SELECT * FROM ratings WHERE ts < 796694400", ["ratings"])
cte("items", """SELECT p_partkey AS item_id,
       concat(p_name, ' (', CAST(1915 + p_partkey % 94 AS VARCHAR), ')') AS title,
       concat(p_type, '|', p_brand) AS genres
FROM part""")
cte("items_dirty", """SELECT item_id, CASE WHEN item_id % 97 = 0 THEN 'untitled' ELSE title END AS title, genres
FROM items""", ["items"])
cte("corrections", """SELECT CAST(7 AS BIGINT) AS old_id, item_id AS new_id, genres AS new_genres
FROM items WHERE item_id = 3""", ["items"])
cte("rated_items", """SELECT r.user_id, r.item_id, r.rating, r.ts, r.bucket, i.title, i.genres
FROM ratings r LEFT JOIN items i ON r.item_id = i.item_id""", ["ratings", "items"])

# --- outer split: test = bucket 0 -----------------------------------------
cte("rated_flag", """SELECT m.*, (bucket = 0
    AND item_id IN (SELECT item_id FROM rated_items WHERE bucket <> 0)
    AND user_id IN (SELECT user_id FROM rated_items WHERE bucket <> 0)) AS keep
FROM rated_items m""", ["rated_items"])
cte("known_raw", "SELECT user_id, item_id, rating, ts, bucket, title, genres FROM rated_flag WHERE NOT keep", ["rated_flag"])
cte("validation_raw", "SELECT user_id, item_id, rating, ts, bucket, title, genres FROM rated_flag WHERE keep", ["rated_flag"])


def _corrected(src: str) -> str:
    return f"""SELECT e.user_id, CASE WHEN c.old_id IS NOT NULL THEN c.new_id ELSE e.item_id END AS item_id,
       e.rating, e.ts, e.bucket, e.title,
       CASE WHEN c.old_id IS NOT NULL THEN c.new_genres ELSE e.genres END AS genres
FROM {src} e LEFT JOIN corrections c ON e.item_id = c.old_id"""


def _featured(src: str) -> str:
    return f"""SELECT *, {release_year_sql('title')} AS release_year,
       {round_period_sql(ts_of_epoch('ts'), 'month')} AS rating_date
FROM {src}"""


cte("known_corr", _corrected("known_raw"), ["known_raw", "corrections"])
cte("known", _featured("known_corr"), ["known_corr"])
cte("validation_corr", _corrected("validation_raw"), ["validation_raw", "corrections"])
cte("validation", _featured("validation_corr"), ["validation_corr"])

# --- inner split: test = bucket 1 of known --------------------------------
cte("known_flag", """SELECT x.*, (bucket = 1
    AND item_id IN (SELECT item_id FROM known WHERE bucket <> 1)
    AND user_id IN (SELECT user_id FROM known WHERE bucket <> 1)) AS keep
FROM known x""", ["known"])
_KNOWN_COLS = "user_id, item_id, rating, ts, bucket, title, genres, release_year, rating_date"
cte("fit_rows", f"SELECT {_KNOWN_COLS} FROM known_flag WHERE NOT keep", ["known_flag"])
cte("tune_rows", f"SELECT {_KNOWN_COLS} FROM known_flag WHERE keep", ["known_flag"])

cte("title_pairs", "SELECT DISTINCT item_id, title FROM known_raw", ["known_raw"])
cte("item_titles", """SELECT * FROM title_pairs
WHERE item_id NOT IN (SELECT old_id FROM corrections)""", ["title_pairs", "corrections"])


# --- effect chains ------------------------------------------------------
# (name, key, stat, null_safe)
EFFECTS = [
    ("b_i", "item_id", "sum", False),
    ("b_u", "user_id", "sum", False),
    ("b_y", "release_year", "sum", True),
    ("b_t", "rating_date", "sum", True),
    ("b_g", "genres", "mean", True),
]


def _on(a: str, b: str, keys: list[str], null_safe: bool) -> str:
    conds = []
    for k in keys:
        op = "IS NOT DISTINCT FROM" if (null_safe and k == keys[-1]) else "="
        conds.append(f"{a}.{k} {op} {b}.{k}")
    return " AND ".join(conds)


def effect_chain_ctes(train: str, test: str, upto: int, lam: str | None, prefix: str,
                      by: list[str] = (), lam_table: str | None = None):
    """CTEs fitting ``upto`` effects the direct way, plus ``{prefix}pred``.

    lam: None for plain means, else an SQL expression for the constant
    (a number, or ``l.lambda`` when ``lam_table`` supplies rows of lambdas;
    then every effect table is keyed by lambda too).
    """
    by = list(by)
    grid = lam_table is not None
    lk = by + ['"lambda"'] if grid else by
    ctes = []
    bysel = "".join(f"t.{b}, " for b in by)
    mu_on = " AND ".join(f"t.{b} = m.{b}" for b in by) or "TRUE"
    ctes.append((f"{prefix}mu", f"SELECT {''.join(b + ', ' for b in by)}avg(rating) AS mu FROM {train} GROUP BY ALL"
                 if by else f"SELECT avg(rating) AS mu FROM {train}", [train]))
    for i, (name, key, stat, ns) in enumerate(EFFECTS[:upto]):
        src = f"FROM {train} t JOIN {prefix}mu m ON {mu_on}"
        if grid:
            src += f" CROSS JOIN {lam_table} l"
        resid = "t.rating - m.mu"
        for j, (pn, pk, _, pns) in enumerate(EFFECTS[:i]):
            keys = by + [pk]
            on = _on("t", f"e{j}", keys, pns)
            if grid:
                on += f' AND l."lambda" = e{j}."lambda"'
            src += f" LEFT JOIN {prefix}{pn} e{j} ON {on}"
            resid += f" - e{j}.{pn}"
        if lam is None:
            val = f"avg({resid})"
        elif stat == "mean":
            val = f"avg({resid}) / (count(*) + {lam})"
        else:
            val = f"sum({resid}) / (count(*) + {lam})"
        lsel = 'l."lambda", ' if grid else ""
        gb = ", ".join([f"t.{b}" for b in by] + (['l."lambda"'] if grid else []) + [f"t.{key}"])
        ctes.append((f"{prefix}{name}", f"SELECT {bysel}{lsel}t.{key}, {val} AS {name} {src} GROUP BY {gb}",
                     [train, f"{prefix}mu"] + [f"{prefix}{pn}" for pn, *_ in EFFECTS[:i]]
                     + ([lam_table] if grid else [])))
    src = f"FROM {test} t JOIN {prefix}mu m ON {mu_on}"
    if grid:
        src += f" CROSS JOIN {lam_table} l"
    pred = "m.mu"
    parts = []
    for j, (pn, pk, _, pns) in enumerate(EFFECTS[:upto]):
        on = _on("t", f"e{j}", by + [pk], pns)
        if grid:
            on += f' AND l."lambda" = e{j}."lambda"'
        src += f" LEFT JOIN {prefix}{pn} e{j} ON {on}"
        pred += f" + e{j}.{pn}"
        parts.append(f"e{j}.{pn} AS {pn}")
    lsel = 'l."lambda", ' if grid else ""
    ctes.append((f"{prefix}pred", f"SELECT t.*, {lsel}{', '.join(parts + [''])}{pred} AS pred {src}",
                 [test, f"{prefix}mu"] + [f"{prefix}{pn}" for pn, *_ in EFFECTS[:upto]]
                 + ([lam_table] if grid else [])))
    return ctes


def rmse_select(src: str, group: list[str] = (), extra_sel: str = "") -> str:
    g = list(group)
    gsel = "".join(f"{c}, " for c in g)
    body = (f"SELECT {extra_sel}{gsel}round(CASE WHEN count(pred) = count(*) THEN sqrt(avg(power(rating - pred, 2))) END, 6) AS rmse, "
            f"count(*) AS n, count(*) - count(pred) AS n_unscored FROM {src}")
    return body + (f" GROUP BY {', '.join(g)}" if g else "")


def lambdas_values(lams=LAMBDAS) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"(CAST({x!r} AS DOUBLE))" for x in lams) + ') v("lambda")'
