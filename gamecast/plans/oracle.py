"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

They read the driver tables directly (flat joins), independent of the nested
games the Spark side builds, and follow the same rules (see sources/testbed.py).
"""

from __future__ import annotations

P, T, A_MUL, B_MUL = 2147483647, 1503238553, 2654435761, 1597334677

BASE = """
sc AS (
  SELECT l_orderkey, l_linestatus, SUM(CAST(l_quantity AS INTEGER)) AS score,
         MIN(l_suppkey) AS min_supp_status
  FROM lineitem GROUP BY l_orderkey, l_linestatus
),
g AS (
  SELECT o.o_orderkey AS game_id, o.o_orderdate AS date,
         cn.n_name AS home_abbr, sn.n_name AS away_abbr,
         CAST(COALESCE(hs.score, 0) AS INTEGER) AS home_score,
         CAST(COALESCE(vs.score, 0) AS INTEGER) AS away_score,
         CAST(o.o_orderkey % 2 AS INTEGER) AS home_pos
  FROM orders o
  JOIN (SELECT l_orderkey, MIN(l_suppkey) AS away_supp FROM lineitem GROUP BY l_orderkey) m
    ON m.l_orderkey = o.o_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation cn ON cn.n_nationkey = c.c_nationkey
  JOIN supplier s ON s.s_suppkey = m.away_supp
  JOIN nation sn ON sn.n_nationkey = s.s_nationkey
  LEFT JOIN sc hs ON hs.l_orderkey = o.o_orderkey AND hs.l_linestatus = 'F'
  LEFT JOIN sc vs ON vs.l_orderkey = o.o_orderkey AND vs.l_linestatus = 'O'
),
pr AS (
  SELECT g.game_id, g.date,
         CAST(CASE WHEN l.l_linestatus = 'F' THEN g.home_pos ELSE 1 - g.home_pos END AS INTEGER) AS bpos,
         CAST(row_number() OVER (PARTITION BY l.l_orderkey, l.l_linestatus
              ORDER BY l.l_linenumber, l.l_partkey, l.l_extendedprice) - 1 AS INTEGER) AS ppos,
         CASE WHEN l.l_linestatus = 'F' THEN 'home' ELSE 'away' END AS side,
         l.l_linestatus = 'F' AS home,
         CASE WHEN l.l_linestatus = 'F' THEN g.home_abbr ELSE g.away_abbr END AS team,
         CASE WHEN l.l_linestatus = 'F' THEN g.away_abbr ELSE g.home_abbr END AS opponent,
         g.home_abbr, g.away_abbr,
         CAST(CASE WHEN l.l_linestatus = 'F' THEN g.home_score > g.away_score
                   ELSE g.away_score > g.home_score END AS INTEGER) AS won,
         CAST(l.l_suppkey AS VARCHAR) AS player, CAST(l.l_quantity AS INTEGER) AS pts
  FROM lineitem l JOIN g ON g.game_id = l.l_orderkey
),
ps AS (
  SELECT *, row_number() OVER (PARTITION BY player ORDER BY date, game_id, bpos, ppos) - 1 AS idx
  FROM pr
),
tr AS (
  SELECT game_id, date, CAST(home_pos AS INTEGER) AS tpos, 'home' AS side, true AS home,
         home_abbr AS abbreviation, home_abbr AS name, home_score AS score,
         CAST(home_score > away_score AS INTEGER) AS won, away_abbr AS opponent FROM g
  UNION ALL
  SELECT game_id, date, CAST(1 - home_pos AS INTEGER), 'away', false,
         away_abbr, away_abbr, away_score,
         CAST(away_score > home_score AS INTEGER), home_abbr FROM g
),
ts AS (
  SELECT *, row_number() OVER (PARTITION BY abbreviation ORDER BY date, game_id, tpos) - 1 AS idx
  FROM tr
),
req AS (
  SELECT game_id AS request_id, date AS rdate, home_abbr, away_abbr FROM g
),
ros AS (
  SELECT game_id AS request_id, side, player, CAST(SUM(pts) AS BIGINT) AS pts
  FROM pr GROUP BY game_id, side, player
),
rp AS (
  SELECT r.request_id, r.side, r.player, q.rdate,
         year(q.rdate) AS ry, month(q.rdate) AS rm, day(q.rdate) AS rd,
         CASE WHEN r.side = 'home' THEN q.away_abbr ELSE q.home_abbr END AS opp
  FROM ros r JOIN req q ON q.request_id = r.request_id
)"""


def with_base(body: str, extra: str = "") -> str:
    return "WITH " + BASE + (",\n" + extra if extra else "") + "\n" + body


def sums(x: str = "idx", y: str = "pts") -> str:
    return (f"COUNT(*) AS n, SUM(CAST({x} AS DOUBLE)) AS sx, SUM(CAST({y} AS DOUBLE)) AS sy, "
            f"SUM(CAST({x} AS DOUBLE) * CAST({x} AS DOUBLE)) AS sxx, "
            f"SUM(CAST({x} AS DOUBLE) * CAST({y} AS DOUBLE)) AS sxy, "
            f"SUM(CAST({y} AS DOUBLE) * CAST({y} AS DOUBLE)) AS syy")


def model(reg: float = 0.0) -> str:
    """slope, intercept, rmse, r2 from (n, sx, sy, sxx, sxy, syy); a nested select."""
    dxx = "(CAST(n AS DOUBLE) * sxx - sx * sx)"
    dxy = "(CAST(n AS DOUBLE) * sxy - sx * sy)"
    dyy = "(CAST(n AS DOUBLE) * syy - sy * sy)"
    ols = f"(CASE WHEN {dxx} > 0 AND {dyy} > 0 THEN {dxy} / {dxx} ELSE 0.0 END)"
    if reg:
        slope = (f"(CASE WHEN {dxx} > 0 AND {dyy} > 0 THEN {ols} / "
                 f"(1.0 + {float(reg)!r} / (sqrt({dyy}) / CAST(n AS DOUBLE))) ELSE 0.0 END)")
    else:
        slope = ols
    return (f"SELECT *, (sy - slope * sx) / CAST(n AS DOUBLE) AS intercept, "
            f"sqrt(sse / CAST(n AS DOUBLE)) AS rmse, "
            f"CASE WHEN {dyy} > 0 THEN 1.0 - CAST(n AS DOUBLE) * sse / {dyy} END AS r2 FROM ("
            f"SELECT *, greatest(({dyy} - 2.0 * slope * {dxy} + slope * slope * {dxx}) / CAST(n AS DOUBLE), 0.0) AS sse "
            f"FROM (SELECT *, {slope} AS slope FROM {{src}}) s1) s2")


def finish(keys: str, extra: str = "") -> str:
    """Rounded output columns; expects n_all, n_fit, slope, intercept, rmse, r2."""
    ex = f"{extra}, " if extra else ""
    return (f"{keys}, {ex}n_all AS n, n_fit, round(slope, 6) AS slope, round(intercept, 6) AS intercept, "
            f"round(rmse, 6) AS rmse, round(r2, 6) AS r2, "
            f"round(intercept + slope * CAST(n_all AS DOUBLE), 6) AS prediction")


def row_hash(keys: list[str], x: str = "idx") -> str:
    parts = ", ".join([f"CAST({k} AS VARCHAR)" for k in keys] + [f"CAST({x} AS VARCHAR)"])
    return f"(('0x' || substr(md5(concat_ws('|', {parts})), 1, 8))::BIGINT % {P})"


def in_sample(h: str, rep: str) -> str:
    a = f"(1 + (CAST({rep} AS BIGINT) * {A_MUL}) % {P - 1})"
    b = f"((CAST({rep} AS BIGINT) * {B_MUL}) % {P})"
    return f"((({h}) * {a} + {b}) % {P} < {T})"


def fit_full_sql(src: str, keys: list[str], x: str = "idx", y: str = "pts") -> str:
    k = ", ".join(keys)
    inner = f"(SELECT {k}, {sums(x, y)} FROM {src} GROUP BY {k})"
    m = model().format(src=inner)
    return f"SELECT {finish(k)} FROM (SELECT *, n AS n_all, n AS n_fit FROM ({m}) m0) m1"


def fit_split_sql(src: str, keys: list[str], reg: float = 0.001, x: str = "idx", y: str = "pts",
                  hash_keys: list[str] | None = None) -> str:
    k = ", ".join(keys)
    flag = in_sample(row_hash(hash_keys or keys, x), "0")
    xs, ys = f"CAST({x} AS DOUBLE)", f"CAST({y} AS DOUBLE)"
    agg = (f"SELECT {k}, COUNT(*) AS n_all, COUNT(*) FILTER (WHERE {flag}) AS n_s, "
           f"SUM({xs}) AS sx_a, SUM({ys}) AS sy_a, SUM({xs}*{xs}) AS sxx_a, SUM({xs}*{ys}) AS sxy_a, SUM({ys}*{ys}) AS syy_a, "
           f"SUM({xs}) FILTER (WHERE {flag}) AS sx_s, SUM({ys}) FILTER (WHERE {flag}) AS sy_s, "
           f"SUM({xs}*{xs}) FILTER (WHERE {flag}) AS sxx_s, SUM({xs}*{ys}) FILTER (WHERE {flag}) AS sxy_s, "
           f"SUM({ys}*{ys}) FILTER (WHERE {flag}) AS syy_s FROM {src} GROUP BY {k}")
    pick = ", ".join(f"CASE WHEN n_s > 0 THEN {c}_s ELSE {c}_a END AS {c}" for c in ("sx", "sy", "sxx", "sxy", "syy"))
    sel = f"(SELECT {k}, n_all, CASE WHEN n_s > 0 THEN n_s ELSE n_all END AS n, {pick} FROM ({agg}) a)"
    m = model(reg).format(src=sel)
    return f"SELECT {finish(k)} FROM (SELECT *, n AS n_fit FROM ({m}) m0) m1"


def fit_best_sql(src: str, keys: list[str], reps: int = 100, x: str = "idx", y: str = "pts") -> str:
    k = ", ".join(keys)
    h = row_hash(keys, x)
    ex = (f"(SELECT * FROM (SELECT {k}, {x}, {y}, {h} AS _h, unnest(range(0, {reps})) AS rep FROM {src}) e "
          f"WHERE rep = 0 OR {in_sample('_h', 'rep')})")
    return _best_of(f"(SELECT {k}, rep, {sums(x, y)} FROM {ex} ex GROUP BY {k}, rep)", k)


def _best_of(sums_by_rep: str, k: str) -> str:
    """The model of least RMSE (6 digits) of every key, the earliest rep on ties."""
    m = model().format(src=sums_by_rep)
    ranked = (f"SELECT *, max(CASE WHEN rep = 0 THEN n END) OVER (PARTITION BY {k}) AS n_all, "
              f"row_number() OVER (PARTITION BY {k} ORDER BY round(rmse, 6), rep) AS _rk FROM ({m}) m0")
    return f"SELECT {finish(k, 'rep')} FROM (SELECT *, n AS n_fit FROM ({ranked}) r WHERE _rk = 1) m1"


def fit_best_as_of_sql(requests: str, src: str, keys: list[str], out: list[str], reps: int = 100) -> str:
    """Best-of fits on the points (`src`: keys, date, idx, pts) before each request's rdate, by running sums.

    `out`: the columns of `requests` that name a request and its series.
    """
    k, o = ", ".join(keys), ", ".join(out)
    same = " AND ".join(f"p.{c} = q.{c}" for c in keys)
    cuts = (f"(SELECT {', '.join('q.' + c for c in out)}, COUNT(*) AS before FROM {requests} q JOIN {src} p "
            f"ON {same} AND p.date < q.rdate GROUP BY {', '.join('q.' + c for c in out)})")
    points = (f"(SELECT *, CAST(CASE WHEN rep = 0 OR {in_sample('_h', 'rep')} THEN 1 ELSE 0 END AS DOUBLE) AS f FROM ("
              f"SELECT {k}, CAST(idx AS DOUBLE) AS x, CAST(pts AS DOUBLE) AS y, idx + 1 AS before, {row_hash(keys)} AS _h, "
              f"unnest(range(0, {reps})) AS rep FROM {src}) e)")
    terms = {"n": "f", "sx": "f * x", "sy": "f * y", "sxx": "f * x * x", "sxy": "f * x * y", "syy": "f * y * y"}
    run = (f"(SELECT {k}, before, rep, " + ", ".join(f"SUM({t}) OVER w AS {c}" for c, t in terms.items())
           + f" FROM {points} pt WINDOW w AS (PARTITION BY {k}, rep ORDER BY x))")
    at = (f"(SELECT {o}, rep, CAST(n AS BIGINT) AS n, sx, sy, sxx, sxy, syy FROM {cuts} c JOIN {run} r "
          f"USING ({k}, before) WHERE n > 0)")
    return _best_of(at, o)
