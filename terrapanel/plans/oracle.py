"""Plain-SQL statements of the named queries, for an independent engine (DuckDB).

The fixture views are written once as CTEs; each query names the views it
needs and they are emitted in dependency order.  Doubles are rounded to six
decimals and integers are BIGINT, mirroring :func:`terrapanel.plans.common.tidy`.
"""

from __future__ import annotations

from terrapanel.functions.stats import solve_stages, stages_as_ctes, t_tail_sql
from terrapanel.functions.weather import FLAG_HOURS
from terrapanel.operators.regress import (
    GROUP_FACTORS,
    GROUP_TARGET,
    PANEL_COLUMNS,
    POOLED_FACTORS,
    POOLED_TARGETS,
    ridge_stages,
)
from terrapanel.operators.stats import corr_sql, cov_col, mean_col, sd_col
from terrapanel.sources.tables import (
    FILE_KEYS,
    INDICATOR_CODE,
    INDICATOR_NAME,
    ISO_EXCLUDED_REGION,
    PRCP_FLAG_LETTERS,
)

D = "CAST({} AS DOUBLE)".format


def r6(expr: str) -> str:
    """Round as Spark does in ``tidy``: to 9 places, then to 6 on the decimal text.

    Spark rounds the shortest decimal form of a double half-up; DuckDB's
    ``round`` works on the binary value, so a tie such as 6.4565625 would go
    the other way.  Rounding the decimal text makes both engines agree, and
    the first step absorbs last-bit noise from summation order.  "+ 0.0"
    turns -0.0 into 0.0.
    """
    return (f"(CAST(round(CAST(CAST(round({expr}, 9) AS VARCHAR) AS DECIMAL(38, 18)), 6) AS DOUBLE)"
            f" + 0.0)")


_WEIGHTS = ", ".join(f"('{k}', {v})" for k, v in FLAG_HOURS.items())

VIEWS: dict[str, tuple[list[str], str]] = {
    "station_days": ([], f"""
SELECT l_suppkey AS station, CAST(l_shipdate AS DATE) AS obs_date,
       l_quantity + 30 AS temp,
       CASE WHEN l_discount > {D(0.095)} THEN {D(99.9)} ELSE round(l_discount * 10, 2) END AS prcp,
       substr('{PRCP_FLAG_LETTERS}', CAST(l_partkey % 10 AS INT) + 1, 1) AS prcp_flag,
       CASE WHEN l_tax > {D(0.075)} THEN {D(999.9)} ELSE round(l_tax * 10, 2) END AS snow_depth
FROM lineitem"""),
    "stations": ([], f"""
SELECT s_suppkey AS station,
       CASE WHEN s_suppkey % 50 <> 0 THEN ((s_suppkey * 7919) % 18001) / {D(100)} - 90 END AS latitude,
       CASE WHEN s_suppkey % 50 <> 0 THEN ((s_suppkey * 104729) % 36001) / {D(100)} - 180 END AS longitude,
       n_name AS country_code
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""),
    "obs": (["station_days", "stations"], """
SELECT d.*, s.latitude, s.longitude, s.country_code
FROM station_days d LEFT JOIN stations s ON d.station = s.station"""),
    "file_days": (["stations"], f"""
SELECT d.*, s.latitude, s.longitude FROM (
  SELECT (l_orderkey * 10 + l_linenumber) % {FILE_KEYS} AS fault, l_suppkey AS station, CAST(l_shipdate AS DATE) AS obs_date,
         l_quantity + 30 AS temp,
         CASE WHEN l_discount > {D(0.095)} THEN {D(99.9)} ELSE round(l_discount * 10, 2) END AS prcp,
         substr('{PRCP_FLAG_LETTERS}', CAST(l_partkey % 10 AS INT) + 1, 1) AS prcp_flag,
         CASE WHEN l_tax > {D(0.075)} THEN {D(999.9)} ELSE round(l_tax * 10, 2) END AS snow_depth
  FROM lineitem) d LEFT JOIN stations s ON d.station = s.station"""),
    "weights": ([], f"SELECT * FROM (VALUES {_WEIGHTS}) AS w(flag, hours)"),
    "clean": (["obs", "weights"], f"""
SELECT o.*, year(o.obs_date) AS year, month(o.obs_date) AS month, o.temp AS temperature,
       CASE WHEN o.prcp = {D(99.9)} THEN {D(0)} ELSE o.prcp * w.hours END AS precipitation,
       CASE WHEN o.snow_depth = {D(999.9)} THEN {D(0)} ELSE o.snow_depth END AS snow
FROM obs o JOIN weights w ON w.flag = coalesce(trim(o.prcp_flag), '')"""),
    "wx": (["clean"], """
SELECT country_code, year, avg(temperature) AS temperature, avg(precipitation) AS precipitation,
       sum(snow) AS snow, count(*) AS n_obs
FROM clean WHERE latitude IS NOT NULL AND longitude IS NOT NULL
GROUP BY country_code, year"""),
    "monthly": (["clean"], """
SELECT year, month, avg(temperature) AS temperature, avg(precipitation) AS precipitation,
       count(*) AS n_obs
FROM clean GROUP BY year, month"""),
    "ord": ([], """
SELECT n_nationkey, n_name, o_orderstatus, o_totalprice, year(o_orderdate) AS year
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""),
    "indicators": (["ord"], f"""
SELECT n_name AS country_code, year,
       avg(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) / {D(1000)} AS co2,
       avg(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) / {D(1000)} AS energy,
       CAST(count(*) AS DOUBLE) AS population
FROM ord GROUP BY n_name, year"""),
    "panel": (["wx", "indicators"], """
SELECT w.country_code, w.year, w.temperature, w.precipitation, i.co2, i.energy, i.population
FROM wx w JOIN indicators i ON w.country_code = i.country_code AND w.year = i.year
WHERE i.co2 IS NOT NULL AND i.energy IS NOT NULL AND i.population IS NOT NULL"""),
    "avgco2": (["panel"], """
SELECT country_code, avg(CAST(co2 AS FLOAT)) AS avg_co2 FROM panel GROUP BY country_code"""),
    "top10": (["avgco2"], """
SELECT * FROM avgco2 ORDER BY avg_co2 DESC NULLS LAST, country_code LIMIT 10"""),
    "low10": (["avgco2"], """
SELECT * FROM avgco2 ORDER BY avg_co2 ASC NULLS LAST, country_code LIMIT 10"""),
    "gaps": (["ord"], f"""
SELECT n_name AS country_name, 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS country_id, year,
       CASE WHEN NOT ((n_nationkey * 7 + year * 3) % 5 = 0 OR (n_nationkey % 8 = 3 AND year % 2 = 0))
            THEN avg(o_totalprice) / {D(1000)} END AS value
FROM ord GROUP BY n_nationkey, n_name, year"""),
    "gazetteer": ([], """
SELECT c_custkey AS place_id,
       ((c_custkey * 6131) % 18001) / CAST(100 AS DOUBLE) - 90 AS latitude,
       ((c_custkey * 51137) % 36001) / CAST(100 AS DOUBLE) - 180 AS longitude,
       n_name AS cc
FROM customer JOIN nation ON c_nationkey = n_nationkey"""),
    "iso_codes": ([], f"""
SELECT n_name AS alpha_2, 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS alpha_3
FROM nation WHERE n_regionkey <> {ISO_EXCLUDED_REGION}"""),
}


def _collect(names: list[str], out: list[str]) -> None:
    for name in names:
        deps, _ = VIEWS[name]
        _collect(deps, out)
        if name not in out:
            out.append(name)


def sql(uses: list[str], body: str, extra_ctes: str = "") -> str:
    order: list[str] = []
    _collect(uses, order)
    ctes = [f"{name} AS ({VIEWS[name][1]}\n)" for name in order]
    if extra_ctes:
        ctes.append(extra_ctes)
    head = "WITH " + ",\n".join(ctes) + "\n" if ctes else ""
    return head + body


MEASURES = ["temperature", "precipitation", "co2", "energy", "population"]


def _moments_select(cols: list[str], cross: bool = True) -> str:
    parts = ["count(*) AS n"]
    for c in cols:
        parts += [f"avg({c}) AS {mean_col(c)}", f"stddev_pop({c}) AS {sd_col(c)}"]
    if cross:
        for i, a in enumerate(cols):
            for b in cols[i + 1:]:
                parts.append(f"covar_pop({a}, {b}) AS {cov_col(a, b)}")
    return ", ".join(parts)


def _group_betas_sql() -> tuple[str, str]:
    cols = [GROUP_TARGET] + list(GROUP_FACTORS)
    k = len(GROUP_FACTORS)
    a = [[corr_sql(GROUP_FACTORS[i], GROUP_FACTORS[j], cols) for j in range(k)] for i in range(k)]
    rhs = [[corr_sql(f, GROUP_TARGET, cols) for f in GROUP_FACTORS]]
    stages, sol = solve_stages(a, rhs, prefix="_gb_")
    gm = f"gm AS (SELECT country_code, {_moments_select(cols)} FROM panel GROUP BY country_code)"
    ctes, last = stages_as_ctes("gm", stages, "gb")
    betas = (f"betas AS (SELECT country_code, CASE WHEN {sol[0][0]} IS NOT NULL THEN {D(0)} END AS intercept, "
             + ", ".join(f"{sol[0][i]} AS {f}" for i, f in enumerate(GROUP_FACTORS))
             + f" FROM {last})")
    return gm + ",\n" + ctes + ",\n" + betas, "betas"


def _betas_out(where: str = "", limit: str = "") -> str:
    cols = ["country_code", r6("intercept")] + [r6(f) for f in GROUP_FACTORS]
    names = ["country_code", "intercept"] + list(GROUP_FACTORS)
    sel = ", ".join(f"{c} AS {n}" for c, n in zip(cols, names))
    return f"SELECT {sel} FROM betas {where} {limit}"


def _ridge_sql() -> tuple[str, list[list[str]], dict[str, str]]:
    targets, factors = list(POOLED_TARGETS), list(POOLED_FACTORS)
    stages, sol, rss = ridge_stages(targets, factors, 1.0)
    rm = f"rm AS (SELECT {_moments_select(targets + factors)} FROM panel)"
    ctes, last = stages_as_ctes("rm", stages, "rf")
    return rm + ",\n" + ctes + f",\nsolved AS (SELECT * FROM {last})", sol, rss


def _ridge_three_factor() -> str:
    ctes, sol, _ = _ridge_sql()
    parts = []
    for r, t in enumerate(POOLED_TARGETS):
        parts.append(f"SELECT '{t}' AS target, 'intercept' AS term, "
                     f"CASE WHEN {sol[r][0]} IS NOT NULL THEN {D(0)} END AS beta FROM solved")
        for i, f in enumerate(POOLED_FACTORS):
            parts.append(f"SELECT '{t}' AS target, '{f}' AS term, {sol[r][i]} AS beta FROM solved")
    body = f"SELECT target, term, {r6('beta')} AS beta FROM (" + " UNION ALL ".join(parts) + ") u"
    return sql(["panel"], body, ctes)


def _ridge_tests() -> str:
    ctes, sol, rss = _ridge_sql()
    p = len(POOLED_FACTORS)
    spread = (p + 1) - 1.0 / (p + 1)
    dof = f"(n - {PANEL_COLUMNS + 1})"
    parts = []
    for r, t in enumerate(POOLED_TARGETS):
        se = f"CASE WHEN {dof} > 0 THEN sqrt(({rss[t]}) / {dof} / (n * {D(repr(spread))})) END"
        for i, f in enumerate(POOLED_FACTORS):
            parts.append(f"SELECT '{t}' AS target, '{f}' AS factor, {sol[r][i]} AS beta, {se} AS se, "
                         f"CAST({dof} AS BIGINT) AS dof FROM solved")
    tests = ("tests AS (" + " UNION ALL ".join(parts) + "),\n"
             "tt AS (SELECT *, CASE WHEN se > 0 THEN beta / se END AS t FROM tests),\n"
             f"tp AS (SELECT *, {t_tail_sql('t', 'CAST(dof AS DOUBLE)', 'duckdb')} AS p_one_sided FROM tt)")
    body = ("SELECT target, factor, " + ", ".join(
        f"{r6(c)} AS {c}" for c in ["beta", "se"]) + ", dof, " + r6("t") + " AS t, "
        + r6("p_one_sided") + " AS p_one_sided, " + r6("2 * p_one_sided") + " AS p_two_sided, "
        "CASE WHEN p_one_sided < 0.05 THEN 'reject' ELSE 'accept' END AS decision FROM tp")
    return sql(["panel"], body, ctes + ",\n" + tests)


def _ridge_predictions() -> str:
    ctes, sol, _ = _ridge_sql()
    cols = list(POOLED_TARGETS) + list(POOLED_FACTORS)
    z = {c: f"(p.{c} - s.{mean_col(c)}) / s.{sd_col(c)}" for c in cols}
    preds = {}
    for r, t in enumerate(POOLED_TARGETS):
        preds[t] = "(" + " + ".join(f"s.{sol[r][i]} * {z[f]}" for i, f in enumerate(POOLED_FACTORS)) + ")"
    sel = ["p.country_code", "CAST(p.year AS BIGINT) AS year"]
    sel += [f"{r6(preds[t])} AS pred_{t}" for t in POOLED_TARGETS]
    sel += [f"{r6(f'pow({preds[t]} - {z[t]}, 2)')} AS sq_err_{t}" for t in POOLED_TARGETS]
    body = f"SELECT {', '.join(sel)} FROM panel p, solved s"
    return sql(["panel"], body, ctes)


def _gram_entries() -> str:
    cols = list(POOLED_TARGETS) + list(POOLED_FACTORS)
    design = ["bias"] + list(POOLED_FACTORS)
    parts = []
    for i, a in enumerate(design):
        for b in design[i:] + list(POOLED_TARGETS):
            if a == "bias" and b == "bias":
                val = "CAST(n AS DOUBLE)"
            elif a == "bias" or b == "bias":
                val = D(0)
            else:
                val = f"n * {corr_sql(a, b, cols)}"
            parts.append(f"SELECT '{a}' AS row_term, '{b}' AS col_term, {r6(val)} AS value FROM rm")
    rm = f"rm AS (SELECT {_moments_select(cols)} FROM panel)"
    return sql(["panel"], " UNION ALL ".join(parts), rm)


def _zscores(by_group: bool) -> str:
    if by_group:
        m = f"m AS (SELECT country_code, {_moments_select(MEASURES, cross=False)} FROM panel GROUP BY country_code)"
        join = "JOIN m ON p.country_code = m.country_code"
    else:
        m = f"m AS (SELECT {_moments_select(MEASURES, cross=False)} FROM panel)"
        join = ", m"
    zs = ", ".join(
        f"{r6(f'CASE WHEN m.{sd_col(c)} > 0 THEN (p.{c} - m.{mean_col(c)}) / m.{sd_col(c)} END')} AS z_{c}"
        for c in MEASURES)
    body = f"SELECT p.country_code, CAST(p.year AS BIGINT) AS year, {zs} FROM panel p {join}"
    return sql(["panel"], body, m)


def _group_moments() -> str:
    cols = MEASURES
    parts = ["country_code", "count(*) AS n"]
    for c in cols:
        parts += [f"{r6(f'avg({c})')} AS {mean_col(c)}", f"{r6(f'stddev_pop({c})')} AS {sd_col(c)}"]
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            parts.append(f"{r6(f'covar_pop({a}, {b})')} AS {cov_col(a, b)}")
    return sql(["panel"], f"SELECT {', '.join(parts)} FROM panel GROUP BY country_code")


def _panel_out(src: str = "panel", where: str = "") -> str:
    return (f"SELECT country_code, CAST(year AS BIGINT) AS year, "
            + ", ".join(f"{r6(c)} AS {c}" for c in MEASURES) + f" FROM {src} {where}")


def _gb(body: str) -> str:
    ctes, _ = _group_betas_sql()
    return sql(["panel", "top10", "low10"], body, ctes)


IND_MIN_CELLS = 9
_IND = f"""
ents AS (SELECT DISTINCT country_name, country_id FROM gaps),
yrs AS (SELECT DISTINCT year FROM gaps),
ncols AS (SELECT count(*) AS t FROM yrs),
cells AS (
  SELECT e.country_name, e.country_id, y.year, g.value
  FROM ents e CROSS JOIN yrs y
  LEFT JOIN gaps g ON g.country_id = e.country_id AND g.year = y.year),
kept AS (SELECT country_id FROM cells GROUP BY country_id HAVING 4 + count(value) >= {IND_MIN_CELLS}),
kc AS (SELECT * FROM cells WHERE country_id IN (SELECT country_id FROM kept)),
pres AS (SELECT country_id, year, value FROM kc WHERE value IS NOT NULL),
pd AS (
  SELECT a.country_id AS code_a, b.country_id AS code_b, count(*) AS n_shared,
         sqrt(CAST((SELECT t FROM ncols) AS DOUBLE) / count(*) * sum(pow(a.value - b.value, 2))) AS distance
  FROM pres a JOIN pres b ON a.year = b.year AND a.country_id <> b.country_id
  GROUP BY a.country_id, b.country_id),
miss AS (SELECT country_id AS a, year FROM kc WHERE value IS NULL),
cand AS (
  SELECT m.a, m.year, d.code_b AS b, d.distance, p.value AS vb
  FROM miss m JOIN pd d ON d.code_a = m.a
  JOIN pres p ON p.country_id = d.code_b AND p.year = m.year),
rk AS (SELECT *, row_number() OVER (PARTITION BY a, year ORDER BY distance, b) AS r FROM cand),
nn AS (SELECT a, year, avg(vb) AS knn, count(*) AS n_donors FROM rk WHERE r <= 2 GROUP BY a, year),
ym AS (SELECT year, avg(value) AS ymean FROM pres GROUP BY year),
fill AS (
  SELECT m.a AS country_id, m.year, coalesce(nn.knn, ym.ymean) AS imputed,
         coalesce(nn.n_donors, 0) AS n_donors
  FROM miss m LEFT JOIN nn ON nn.a = m.a AND nn.year = m.year LEFT JOIN ym ON ym.year = m.year)"""


# The orders of the fixture span these years; a column for each, as views allow no dynamic pivot.
_YEAR_COLUMNS = ", ".join(
    f'max(CASE WHEN year = {y} THEN {r6("value")} END) AS "{y}"' for y in range(1995, 2002))


def _ind(body: str) -> str:
    return sql(["gaps"], body, _IND.strip())


N_TRAIN, N_TEST = 72, 10
_SERIES = f"""
ml AS (
  SELECT 'temperature' AS series, make_date(CAST(year AS BIGINT), CAST(month AS BIGINT), 1) AS month,
         temperature AS value FROM monthly
  UNION ALL
  SELECT 'precipitation', make_date(CAST(year AS BIGINT), CAST(month AS BIGINT), 1), precipitation FROM monthly),
pos AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY month) AS position FROM ml),
sp AS (SELECT *, CASE WHEN position <= {N_TRAIN} THEN 'train' ELSE 'test' END AS split
       FROM pos WHERE position <= {N_TRAIN + N_TEST}),
lastseason AS (
  SELECT series, month(month) AS moy, arg_max(value, month) AS predicted
  FROM sp WHERE split = 'train' GROUP BY series, month(month)),
naive AS (
  SELECT s.series, s.month, s.value AS actual, l.predicted
  FROM sp s LEFT JOIN lastseason l ON l.series = s.series AND l.moy = month(s.month)
  WHERE s.split = 'test')"""


def _ser(body: str) -> str:
    return sql(["monthly"], body, _SERIES.strip())


# Two-stage starting values: lag lists as plain numbers, designs by self-joins on the position, and
# Gauss-Jordan elimination of [X'X | X'y] by recursion, once for the long autoregression and once for the model.
_ARMA = """
ord_(series, order_label, diffs, own, ars, mas) AS (VALUES
  ('temperature', '(2,1,1)(2,1,1,12)', [(0, 1), (1, -1), (12, -1), (13, 1)], 13, [1, 2, 12, 24], [1, 12]),
  ('temperature', '(1,1,1)(1,1,1,12)', [(0, 1), (1, -1), (12, -1), (13, 1)], 13, [1, 12], [1, 12]),
  ('temperature', '(0,1,1)(0,1,1,12)', [(0, 1), (1, -1), (12, -1), (13, 1)], 13, []::INT[], [1, 12]),
  ('precipitation', '(1,1,3)(1,1,1,12)', [(0, 1), (1, -1), (12, -1), (13, 1)], 15, [1, 12], [1, 2, 3, 12]),
  ('precipitation', '(1,1,1)(1,1,1,12)', [(0, 1), (1, -1), (12, -1), (13, 1)], 13, [1, 12], [1, 12]),
  ('precipitation', '(0,1,1)(0,1,1,12)', [(0, 1), (1, -1), (12, -1), (13, 1)], 13, []::INT[], [1, 12])),
tr_ AS (SELECT series, position AS t, value AS y FROM sp WHERE split = 'train'),
d_ AS (SELECT o.*, unnest(diffs) AS d FROM ord_ o),
w_ AS (
  SELECT o.series, o.order_label, a.t, sum(o.d[2] * b.y) AS w
  FROM tr_ a JOIN d_ o ON o.series = a.series JOIN tr_ b ON b.series = a.series AND b.t = a.t - o.d[1]
  GROUP BY o.series, o.order_label, a.t HAVING count(*) = 4),
x1_ AS (
  SELECT w.series, w.order_label, w.t, w.w AS y, list(p.w ORDER BY w.t - p.t) AS x
  FROM w_ w JOIN ord_ o USING (series, order_label)
  JOIN w_ p ON p.series = w.series AND p.order_label = w.order_label AND p.t BETWEEN w.t - o.own AND w.t - 1
  GROUP BY w.series, w.order_label, w.t, w.w, o.own HAVING count(*) = o.own),
{solve1},
e_ AS (
  SELECT x.series, x.order_label, x.t, x.y - list_dot_product(x.x, b.beta) AS e
  FROM x1_ x JOIN beta1_ b USING (series, order_label)),
l_ AS (
  SELECT series, order_label, 'ar' AS part, unnest(ars) AS lag FROM ord_
  UNION ALL SELECT series, order_label, 'ma', unnest(mas) FROM ord_),
k_ AS (SELECT *, row_number() OVER (PARTITION BY series, order_label ORDER BY part, lag) AS i,
              count(*) OVER (PARTITION BY series, order_label) AS k FROM l_),
x2_ AS (
  SELECT w.series, w.order_label, w.t, w.w AS y, list(v.v ORDER BY k.i) AS x
  FROM w_ w JOIN k_ k USING (series, order_label)
  JOIN (SELECT series, order_label, 'ar' AS part, t, w AS v FROM w_ UNION ALL SELECT series, order_label, 'ma', t, e FROM e_) v
    ON v.series = w.series AND v.order_label = w.order_label AND v.part = k.part AND v.t = w.t - k.lag
  GROUP BY w.series, w.order_label, w.t, w.w, k.k HAVING count(*) = k.k),
{solve2}"""
_ARMA_SOLVE = """
g{n}_ AS (
  SELECT series, order_label, i, j, sum(list_append(x, y)[i] * list_append(x, y)[j]) AS v, count(*) AS c
  FROM x{n}_, unnest(range(1, len(x) + 1)) a(i), unnest(range(1, len(x) + 2)) b(j) GROUP BY ALL),
r{n}_ AS (SELECT series, order_label, i, list(v ORDER BY j) AS r, any_value(c) AS c FROM g{n}_ GROUP BY ALL),
el{n}_ AS (
  SELECT series, order_label, 0 AS k, list(r ORDER BY i) AS m, any_value(c) AS c FROM r{n}_ GROUP BY series, order_label
  UNION ALL
  SELECT series, order_label, k + 1, list_transform(range(1, len(m) + 1), lambda i:
           CASE WHEN i = k + 1 THEN list_transform(m[i], lambda v: v / m[k + 1][k + 1])
           ELSE list_transform(range(1, len(m[1]) + 1), lambda j: m[i][j] - m[i][k + 1] * m[k + 1][j] / m[k + 1][k + 1]) END), c
  FROM el{n}_ WHERE k < len(m)),
beta{n}_ AS (SELECT series, order_label, c, list_transform(m, lambda r: r[len(r)]) AS beta FROM el{n}_ WHERE k = len(m))"""


def _arma_start() -> str:
    extra = _SERIES.strip() + "," + _ARMA.format(solve1=_ARMA_SOLVE.format(n=1).strip(), solve2=_ARMA_SOLVE.format(n=2).strip())
    body = f"""
SELECT series, order_label, part, CAST(lag AS BIGINT) AS lag, {r6('beta[i]')} AS start, c AS n_rows
FROM k_ JOIN beta2_ USING (series, order_label)"""
    return sql(["monthly"], body, extra).replace("WITH ", "WITH RECURSIVE ", 1)


def _month(col: str = "month") -> str:
    return f"strftime({col}, '%Y-%m-%d') AS {col}"


_GEO = """
q AS (SELECT DISTINCT latitude, longitude FROM stations WHERE latitude IS NOT NULL AND longitude IS NOT NULL),
qv AS (SELECT latitude, longitude,
              cos(radians(latitude)) * cos(radians(longitude)) AS x,
              cos(radians(latitude)) * sin(radians(longitude)) AS y, sin(radians(latitude)) AS z FROM q),
gv AS (SELECT place_id, cc,
              cos(radians(latitude)) * cos(radians(longitude)) AS x,
              cos(radians(latitude)) * sin(radians(longitude)) AS y, sin(radians(latitude)) AS z FROM gazetteer),
pairs AS (SELECT q.latitude, q.longitude, g.place_id, g.cc,
                 sqrt(pow(q.x - g.x, 2) + pow(q.y - g.y, 2) + pow(q.z - g.z, 2)) AS chord
          FROM qv q CROSS JOIN gv g),
best AS (SELECT * FROM (
           SELECT *, row_number() OVER (PARTITION BY latitude, longitude ORDER BY chord, place_id) AS r
           FROM pairs) WHERE r = 1),
codes AS (SELECT b.*, coalesce(i.alpha_3, 'NA') AS country_code
          FROM best b LEFT JOIN iso_codes i ON b.cc = i.alpha_2)"""


def _geo(body: str, uses: list[str] | None = None) -> str:
    return sql((uses or []) + ["stations", "gazetteer", "iso_codes"], body, _GEO.strip())


_MAP = """
pts AS (SELECT ' ' || cc AS code_3, cc AS Country, avg(latitude) AS Latitude, avg(longitude) AS Longitude
        FROM gazetteer GROUP BY cc),
cpc AS (SELECT country_code AS code_3, avg_co2 AS co2 FROM avgco2),
merged AS (SELECT trim(p.code_3) AS code_3, p.Country, p.Latitude, p.Longitude, c.co2
           FROM pts p JOIN cpc c ON trim(p.code_3) = trim(c.code_3)),
feat AS (SELECT code_3, Country AS country, Latitude AS latitude, Longitude AS longitude,
                CAST(5 AS BIGINT) AS radius,
                printf('Country : %s<br>' || chr(10) || '                    Average co2 emission(kt) : %s<br>',
                       Country, CAST(co2 AS VARCHAR)) AS popup,
                CASE WHEN co2 < 2 THEN 'green' WHEN co2 >= 2 AND co2 < 10 THEN 'orange' ELSE 'red' END
                  AS fill_color,
                'grey' AS color, CAST(0.7 AS DOUBLE) AS fill_opacity
         FROM merged)"""


def _map(body: str) -> str:
    return sql(["gazetteer", "avgco2"], body, _MAP.strip())


# The fixed-effects ridge from raw panel rows: a dense z-scored design with a bias column, normal
# equations, Gauss-Jordan elimination by recursion, and the t tail from its finite series.
_POOLED_FACTORS = ["co2", "energy", "population"]
_POOLED_TARGETS = ["temperature", "precipitation"]
_POOLED = f"""
rows_ AS (SELECT row_number() OVER (ORDER BY country_code, year) AS r, * FROM panel),
size_ AS (SELECT count(*) AS n FROM rows_),
raw_ AS (
  SELECT r, 'CC_' || l.country_code AS term, CAST(p.country_code = l.country_code AS INT) * 1.0::DOUBLE AS v
  FROM rows_ p, (SELECT DISTINCT country_code FROM panel WHERE country_code > (SELECT min(country_code) FROM panel)) l
  UNION ALL
  SELECT r, 'YEAR_' || CAST(l.year AS VARCHAR), CAST(p.year = l.year AS INT) * 1.0::DOUBLE
  FROM rows_ p, (SELECT DISTINCT year FROM panel WHERE year > (SELECT min(year) FROM panel)) l
  {" ".join(f"UNION ALL SELECT r, '{f}', {f} FROM rows_" for f in _POOLED_FACTORS)}),
target_ AS (
  {" UNION ALL ".join(f"SELECT r, '{t}' AS target, ({t} - avg({t}) OVER ()) / stddev_pop({t}) OVER () AS y FROM rows_" for t in _POOLED_TARGETS)}),
design_ AS (
  SELECT r, term, (v - avg(v) OVER (PARTITION BY term)) / stddev_pop(v) OVER (PARTITION BY term) AS x FROM raw_
  UNION ALL SELECT r, 'intercept', 1.0::DOUBLE FROM rows_),
number_ AS (SELECT term, row_number() OVER (ORDER BY term) AS i FROM (SELECT DISTINCT term FROM design_)),
entry_ AS (
  SELECT a.term AS row_term, n.i AS j, sum(a.x * b.x) + CASE WHEN a.term = b.term THEN 1 ELSE 0 END AS v
  FROM design_ a JOIN design_ b ON a.r = b.r JOIN number_ n ON n.term = b.term GROUP BY a.term, b.term, n.i
  UNION ALL
  SELECT a.term, (SELECT count(*) FROM number_) + CASE WHEN t.target = '{_POOLED_TARGETS[0]}' THEN 1 ELSE 2 END, sum(a.x * t.y)
  FROM design_ a JOIN target_ t ON a.r = t.r GROUP BY a.term, t.target),
line_ AS (SELECT n.i, list(e.v ORDER BY e.j) AS v FROM entry_ e JOIN number_ n ON n.term = e.row_term GROUP BY n.i),
gauss_ AS (
  SELECT 0 AS k, list(v ORDER BY i) AS m FROM line_
  UNION ALL
  SELECT k + 1, list_transform(range(1, len(m) + 1), lambda i:
           CASE WHEN i = k + 1 THEN list_transform(m[i], lambda v: v / m[k + 1][k + 1])
           ELSE list_transform(range(1, len(m[1]) + 1), lambda j: m[i][j] - m[i][k + 1] * m[k + 1][j] / m[k + 1][k + 1]) END)
  FROM gauss_ WHERE k < len(m)),
solved_ AS (SELECT m FROM gauss_ WHERE k = len(m)),
beta_ AS (
  SELECT t.target, n.term, s.m[n.i][len(s.m) + t.c] AS beta
  FROM solved_ s, number_ n, (VALUES ('{_POOLED_TARGETS[0]}', 1), ('{_POOLED_TARGETS[1]}', 2)) t(target, c)),
fit_ AS (
  SELECT d.r, b.target, sum(d.x * b.beta) AS pred FROM design_ d JOIN beta_ b ON b.term = d.term GROUP BY d.r, b.target),
miss_ AS (SELECT f.r, f.target, f.pred, pow(f.pred - t.y, 2) AS sq FROM fit_ f JOIN target_ t ON t.r = f.r AND t.target = f.target),
cells_ AS (SELECT sum(pow(x - (SELECT avg(x) FROM design_), 2)) AS spread FROM design_),
se_ AS (
  SELECT target, CAST(n - 8 AS BIGINT) AS dof, sqrt(sum(sq) / (n - 8) / (SELECT spread FROM cells_)) AS se
  FROM miss_, size_ GROUP BY target, n),
test_ AS (
  SELECT b.target, b.term AS factor, b.beta, s.se, s.dof, b.beta / s.se AS t, atan(abs(b.beta / s.se) / sqrt(s.dof)) AS a
  FROM beta_ b JOIN se_ s ON s.target = b.target
  WHERE b.term IN ({", ".join(f"'{f}'" for f in _POOLED_FACTORS)})),
tail_ AS (
  SELECT *, 0.5 - 0.5 * CASE WHEN dof % 2 = 0
    THEN sin(a) * list_sum(list_transform(range(0, dof // 2), lambda j:
           exp(lgamma(j + 0.5) - lgamma(j + 1)) / sqrt(pi()) * pow(cos(a), 2 * j)))
    ELSE 2 / pi() * (a + sin(a) * coalesce(list_sum(list_transform(range(0, (dof - 1) // 2), lambda j:
           sqrt(pi()) / 2 * exp(lgamma(j + 1) - lgamma(j + 1.5)) * pow(cos(a), 2 * j + 1))), 0)) END AS upper FROM test_)"""


def _pooled(body: str) -> str:
    return sql(["panel"], body, _POOLED.strip()).replace("WITH ", "WITH RECURSIVE ", 1)


def _group_betas_min_norm() -> str:
    """Pseudo-inverse by Newton-Schulz steps X <- X (2 I - A X) from X = A / |A|^2, on z-scored panel rows.

    Of use up to the rounding of A: sixty steps reach eigenvalues down to 1e-8, what rounding leaves of a zero one does not grow.
    """
    k, f = len(GROUP_FACTORS), GROUP_FACTORS
    z = ", ".join(f"({c} - avg({c}) OVER g) / nullif(stddev_pop({c}) OVER g, 0) AS z_{c}" for c in [GROUP_TARGET, *f])
    cells = ", ".join(f"avg(z_{a} * z_{b})" for a in f for b in f)
    right = ", ".join(f"avg(z_{a} * z_{GROUP_TARGET})" for a in f)

    def product(left: str, right_: str) -> str:
        row, col = f"({k} * (t // {k}) + l + 1)", f"({k} * l + t % {k} + 1)"
        return (f"list_transform(range({k * k}), lambda t: list_sum(list_transform(range({k}), "
                f"lambda l: {left}[{row}] * {right_}[{col}])))")

    twice_less = f"list_transform(range({k * k}), lambda t: CASE WHEN t // {k} = t % {k} THEN 2 ELSE 0 END - ax[t + 1])"
    ctes = f"""zs AS (SELECT country_code, {z} FROM panel WINDOW g AS (PARTITION BY country_code)),
mats AS (SELECT country_code, [{cells}] AS a, [{right}] AS r FROM zs GROUP BY country_code),
whole AS (SELECT * FROM mats WHERE len(list_filter(a, lambda v: v IS NULL)) + len(list_filter(r, lambda v: v IS NULL)) = 0),
steps AS (
  SELECT country_code, a, 0 AS step, list_transform(a, lambda v: v / list_sum(list_transform(a, lambda w: w * w))) AS x FROM whole
  UNION ALL
  SELECT country_code, a, step + 1, {product('x', 'c')} FROM (
    SELECT *, {twice_less} AS c FROM (SELECT *, {product('a', 'x')} AS ax FROM steps WHERE step < 60))),
found AS (SELECT m.country_code, s.x, m.r FROM mats m LEFT JOIN steps s ON s.country_code = m.country_code AND s.step = 60)"""
    out = ", ".join(f"{r6(' + '.join(f'x[{i * k + j + 1}] * r[{j + 1}]' for j in range(k)))} AS {name}" for i, name in enumerate(f))
    return sql(["panel"], f"SELECT country_code, CASE WHEN x IS NOT NULL THEN {D(0)} END AS intercept, {out} FROM found",
               ctes).replace("WITH ", "WITH RECURSIVE ", 1)


_STORE_MEASURES = f"""{r6('avg(o.temp)')} AS temperature,
       {r6(f"avg(CASE WHEN o.prcp = {D(99.9)} THEN {D(0)} ELSE o.prcp * w.hours END)")} AS precipitation,
       {r6(f"sum(CASE WHEN o.snow_depth = {D(999.9)} THEN {D(0)} ELSE o.snow_depth END)")} AS snow, count(*) AS n_obs
FROM file_days o JOIN weights w ON w.flag = trim(o.prcp_flag)"""
_PYRAMID_ZOOM = 8

ORACLE: dict[str, str] = {
    "group_betas_min_norm": _group_betas_min_norm(),
    "rollup_store_series": sql(["file_days", "stations", "weights"], f"""
SELECT 'country_year' AS grain, s.country_code, CAST(year(o.obs_date) AS BIGINT) AS year, CAST(NULL AS BIGINT) AS month, {_STORE_MEASURES}
JOIN stations s ON s.station = o.station
WHERE o.fault NOT BETWEEN 1 AND 5 AND o.latitude IS NOT NULL AND o.longitude IS NOT NULL
GROUP BY s.country_code, year(o.obs_date)
UNION ALL
SELECT 'month', NULL, CAST(year(o.obs_date) AS BIGINT), CAST(month(o.obs_date) AS BIGINT), {_STORE_MEASURES}
WHERE o.fault NOT BETWEEN 1 AND 5
GROUP BY year(o.obs_date), month(o.obs_date)"""),
    "bucketed_country_month": sql(["clean"], f"""
SELECT country_code, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, {r6('avg(temperature)')} AS temperature,
       {r6('avg(precipitation)')} AS precipitation, {r6('sum(snow)')} AS snow, count(*) AS n_obs
FROM clean WHERE latitude IS NOT NULL AND longitude IS NOT NULL
GROUP BY country_code, year, month"""),
    "reading_lags": sql([], f"""
WITH r AS (SELECT CAST(l_shipdate AS DATE) AS obs_date, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity + 30 AS value FROM lineitem),
n AS (SELECT *, row_number() OVER w - 1 AS position, lag(value, 1) OVER w AS lag_1, lag(value, 12) OVER w AS lag_12,
             lag(value, 13) OVER w AS lag_13, count(*) OVER () AS total FROM r
      WINDOW w AS (ORDER BY obs_date, l_orderkey, l_linenumber, l_partkey, l_suppkey, value))
SELECT strftime(obs_date, '%Y-%m-%d') AS obs_date, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, {r6('value')} AS value, position,
       CASE WHEN position < total * 80 // 100 THEN 'train' ELSE 'test' END AS split,
       {r6('lag_1')} AS lag_1, {r6('lag_12')} AS lag_12, {r6('lag_13')} AS lag_13 FROM n"""),
    "flag_rejects": sql(["weights"], f"""
SELECT l_suppkey AS station, strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') AS obs_date, l_returnflag AS prcp_flag, {r6('l_quantity + 30')} AS temp
FROM lineitem WHERE coalesce(trim(l_returnflag), '') NOT IN (SELECT flag FROM weights)"""),
    "place_emission_class": sql(["gazetteer"], f"""
SELECT 'P' || CAST(place_id AS VARCHAR) AS code_3, cc AS country, {r6('latitude')} AS latitude, {r6('longitude')} AS longitude,
       CASE WHEN v < 2 THEN 'green' WHEN v < 10 THEN 'orange' ELSE 'red' END AS fill_color
FROM gazetteer JOIN (SELECT o_custkey, avg(o_totalprice) / {D(25000)} AS v FROM orders GROUP BY o_custkey) ON o_custkey = place_id"""),
    "place_pyramid": sql(["gazetteer"], f"""
SELECT CAST(z AS BIGINT) AS zoom, CAST(least(floor((longitude + 180) / 360 * pow(2, z)), pow(2, z) - 1) AS BIGINT) AS cell_x,
       CAST(least(floor((latitude + 90) / 180 * pow(2, z)), pow(2, z) - 1) AS BIGINT) AS cell_y, count(*) AS n_points,
       {r6('avg(latitude)')} AS centroid_lat, {r6('avg(longitude)')} AS centroid_lon
FROM gazetteer, range({_PYRAMID_ZOOM + 1}) AS zooms(z)
GROUP BY ALL"""),

    "pooled_effects_coefficients": _pooled(f"SELECT target, term, {r6('beta')} AS beta FROM beta_"),
    "pooled_effects_tests": _pooled(f"""
SELECT target, factor, {r6('beta')} AS beta, {r6('se')} AS se, dof, {r6('t')} AS t,
       {r6('upper')} AS p_one_sided, {r6('2 * upper')} AS p_two_sided,
       CASE WHEN upper < 0.05 THEN 'reject' ELSE 'accept' END AS decision FROM tail_"""),
    "pooled_effects_predictions": _pooled(f"""
SELECT w.country_code, CAST(w.year AS BIGINT) AS year, {r6('a.pred')} AS pred_temperature,
       {r6('b.pred')} AS pred_precipitation, {r6('a.sq')} AS sq_err_temperature, {r6('b.sq')} AS sq_err_precipitation
FROM rows_ w JOIN miss_ a ON a.r = w.r AND a.target = 'temperature'
JOIN miss_ b ON b.r = w.r AND b.target = 'precipitation'"""),
    "obs_clean": sql(["clean"], f"""
SELECT station, strftime(obs_date, '%Y-%m-%d') AS obs_date, country_code, CAST(year AS BIGINT) AS year,
       CAST(month AS BIGINT) AS month, {r6('temperature')} AS temperature,
       {r6('precipitation')} AS precipitation, {r6('snow')} AS snow
FROM clean"""),
    "obs_with_coordinates": sql(["obs"], f"""
SELECT station, strftime(obs_date, '%Y-%m-%d') AS obs_date, {r6('latitude')} AS latitude,
       {r6('longitude')} AS longitude
FROM obs WHERE latitude IS NOT NULL AND longitude IS NOT NULL"""),
    "obs_rejects": sql(["obs", "weights"], """
SELECT station, strftime(obs_date, '%Y-%m-%d') AS obs_date, prcp_flag
FROM obs o WHERE NOT EXISTS (SELECT 1 FROM weights w WHERE w.flag = coalesce(trim(o.prcp_flag), ''))"""),
    "csv_observations": sql(["file_days"], f"""
SELECT CAST(station AS VARCHAR) AS station, strftime(obs_date, '%Y-%m-%d') AS obs_date, {r6('latitude')} AS latitude,
       {r6('longitude')} AS longitude, {r6('temp')} AS temp, {r6('prcp')} AS prcp, trim(prcp_flag) AS prcp_flag,
       {r6('snow_depth')} AS snow_depth
FROM file_days WHERE fault NOT BETWEEN 1 AND 5"""),
    "csv_rejects": sql(["file_days"], """
SELECT CASE WHEN fault <> 3 THEN CAST(station AS VARCHAR) ELSE '' END AS station,
       CASE fault WHEN 1 THEN 'date' WHEN 2 THEN 'number: TEMP' WHEN 3 THEN 'station' ELSE 'fields' END AS reason,
       CASE fault WHEN 4 THEN '"' || array_to_string(f[:27], '","') || '"'
                  WHEN 5 THEN '"' || array_to_string(list_append(f, 'x'), '","') || '"'
                  ELSE array_to_string(f, ',') END AS record
FROM (SELECT fault, station, [
        CASE WHEN fault = 3 THEN ' ' ELSE CAST(station AS VARCHAR) END,
        CASE WHEN fault = 1 THEN '1999-02-30' ELSE strftime(obs_date, '%Y-%m-%d') END,
        coalesce(CAST(latitude AS VARCHAR), ''), coalesce(CAST(longitude AS VARCHAR), ''), '',
        'STATION ' || CAST(station AS VARCHAR) || ', XX',
        CASE WHEN fault = 2 THEN '  n/a ' ELSE lpad(CAST(temp AS VARCHAR), 6, ' ') END,
        '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '',
        lpad(CAST(prcp AS VARCHAR), 6, ' '), prcp_flag, lpad(CAST(snow_depth AS VARCHAR), 6, ' '), '000000'] AS f
      FROM file_days WHERE fault BETWEEN 1 AND 5)"""),
    "csv_country_year": sql(["file_days", "stations", "weights"], f"""
SELECT s.country_code, CAST(year(o.obs_date) AS BIGINT) AS year, {r6('avg(o.temp)')} AS temperature,
       {r6(f"avg(CASE WHEN o.prcp = {D(99.9)} THEN {D(0)} ELSE o.prcp * w.hours END)")} AS precipitation,
       {r6(f"sum(CASE WHEN o.snow_depth = {D(999.9)} THEN {D(0)} ELSE o.snow_depth END)")} AS snow, count(*) AS n_obs
FROM file_days o JOIN weights w ON w.flag = trim(o.prcp_flag) JOIN stations s ON s.station = o.station
WHERE o.fault NOT BETWEEN 1 AND 5 AND o.latitude IS NOT NULL AND o.longitude IS NOT NULL
GROUP BY s.country_code, year(o.obs_date)"""),
    "csv_indicator_long": _ind(f"""
SELECT country_id AS country_code, CAST(year AS BIGINT) AS year, {r6('value')} AS ordervalue FROM pres"""),
    "country_year_means": sql(["wx"], f"""
SELECT country_code, CAST(year AS BIGINT) AS year, {r6('temperature')} AS temperature,
       {r6('precipitation')} AS precipitation, {r6('snow')} AS snow, n_obs FROM wx"""),
    "country_year_rowwise": sql(["wx"], f"""
SELECT country_code, CAST(year AS BIGINT) AS year, {r6('temperature')} AS temperature,
       {r6('precipitation')} AS precipitation, {r6('snow')} AS snow, n_obs FROM wx"""),
    "country_year_stream": sql(["wx"], f"""
SELECT country_code, CAST(year AS BIGINT) AS year, {r6('temperature')} AS temperature,
       {r6('precipitation')} AS precipitation, {r6('snow')} AS snow, n_obs FROM wx"""),
    "month_year_means": sql(["monthly"], f"""
SELECT CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, {r6('temperature')} AS temperature,
       {r6('precipitation')} AS precipitation, n_obs FROM monthly"""),
    "series_drop_year": sql(["monthly"], f"""
SELECT CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, {r6('temperature')} AS temperature,
       {r6('precipitation')} AS precipitation, n_obs
FROM monthly WHERE year IN (SELECT year FROM monthly GROUP BY year HAVING count(*) >= 12)"""),
    "series_drop_first_year": sql(["monthly"], f"""
SELECT CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, {r6('temperature')} AS temperature,
       {r6('precipitation')} AS precipitation, n_obs
FROM monthly WHERE year > (SELECT min(year) FROM monthly)
   OR (SELECT count(*) FROM monthly WHERE year = (SELECT min(year) FROM monthly)) >= 12"""),
    "panel_join": sql(["panel"], _panel_out()),
    "avg_co2_by_country": sql(["avgco2"], f"SELECT country_code, {r6('avg_co2')} AS avg_co2 FROM avgco2"),
    "least_emitting_10": sql(["low10"], f"SELECT country_code, {r6('avg_co2')} AS avg_co2 FROM low10"),
    "most_emitting_10": sql(["top10"], f"SELECT country_code, {r6('avg_co2')} AS avg_co2 FROM top10"),
    "position_slice": sql(["avgco2"], f"""
SELECT country_code, {r6('avg_co2')} AS avg_co2 FROM avgco2
ORDER BY avg_co2 ASC NULLS LAST, country_code LIMIT 10 OFFSET 15"""),
    "most_emitting_panel": sql(["panel", "top10"], _panel_out(
        "panel", "WHERE country_code IN (SELECT country_code FROM top10)")),
    "group_zscores": _zscores(True),
    "group_moments": _group_moments(),
    "group_betas": _gb(_betas_out()),
    "top_betas_10": _gb(_betas_out(limit="ORDER BY co2 DESC NULLS LAST, country_code LIMIT 10")),
    "most_emitting_betas": _gb(_betas_out(
        "WHERE country_code IN (SELECT country_code FROM top10)",
        "ORDER BY co2 DESC NULLS LAST, country_code LIMIT 10")),
    "least_emitting_betas": _gb(_betas_out(
        "WHERE country_code IN (SELECT country_code FROM low10)",
        "ORDER BY co2 DESC NULLS LAST, country_code LIMIT 10")),
    "global_zscores": _zscores(False),
    "dummy_columns": sql(["panel"], """
SELECT country_code, CAST(year AS BIGINT) AS year, 'CC_' || country_code AS dummy, CAST(1 AS BIGINT) AS value
FROM panel WHERE country_code <> (SELECT min(country_code) FROM panel)
UNION ALL
SELECT country_code, CAST(year AS BIGINT) AS year, 'YEAR_' || CAST(year AS VARCHAR) AS dummy,
       CAST(1 AS BIGINT) AS value
FROM panel WHERE year <> (SELECT min(year) FROM panel)"""),
    "gram_entries": _gram_entries(),
    "distinct_coordinates": sql(["clean"], f"""
SELECT {r6('latitude')} AS latitude, {r6('longitude')} AS longitude, count(*) AS n_obs
FROM clean WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY latitude, longitude"""),
    "nearest_place_country": _geo(f"""
SELECT {r6('latitude')} AS latitude, {r6('longitude')} AS longitude, place_id, cc,
       {r6('2 * 6371.0 * asin(least(chord / 2, 1))')} AS distance_km FROM best"""),
    "country_code_lookup": _geo(f"""
SELECT {r6('latitude')} AS latitude, {r6('longitude')} AS longitude, country_code FROM codes"""),
    "geo_country_year_means": _geo(f"""
SELECT c.country_code, CAST(k.year AS BIGINT) AS year, {r6('avg(k.temperature)')} AS temperature,
       {r6('avg(k.precipitation)')} AS precipitation, {r6('sum(k.snow)')} AS snow, count(*) AS n_obs
FROM clean k JOIN codes c ON k.latitude = c.latitude AND k.longitude = c.longitude
GROUP BY c.country_code, k.year""", ["clean"]),
    "study_panel": _geo(f"""
SELECT w.country_code, CAST(w.year AS BIGINT) AS year, {r6('w.temperature')} AS temperature,
       {r6('w.precipitation')} AS precipitation, {r6('c.co2')} AS co2, {r6('e.energy')} AS energy,
       {r6('p.population')} AS population
FROM (SELECT c.country_code, k.year, avg(k.temperature) AS temperature, avg(k.precipitation) AS precipitation
      FROM clean k JOIN codes c ON k.latitude = c.latitude AND k.longitude = c.longitude
      GROUP BY c.country_code, k.year) w
JOIN (SELECT alpha_3, year, co2 FROM indicators JOIN iso_codes ON country_code = alpha_2 WHERE co2 IS NOT NULL) c
  ON c.alpha_3 = w.country_code AND c.year = w.year
JOIN (SELECT alpha_3, year, energy FROM indicators JOIN iso_codes ON country_code = alpha_2 WHERE energy IS NOT NULL) e
  ON e.alpha_3 = w.country_code AND e.year = w.year
JOIN (SELECT alpha_3, year, population FROM indicators JOIN iso_codes ON country_code = alpha_2) p
  ON p.alpha_3 = w.country_code AND p.year = w.year""", ["clean", "indicators"]),
    "code_merge": _map(f"""
SELECT code_3, Country, {r6('Latitude')} AS Latitude, {r6('Longitude')} AS Longitude, {r6('co2')} AS co2
FROM merged"""),
    "emission_class": _map(f"""
SELECT code_3, {r6('co2')} AS co2,
       CASE WHEN co2 < 2 THEN 'green' WHEN co2 >= 2 AND co2 < 10 THEN 'orange' ELSE 'red' END AS fill_color
FROM merged"""),
    "popup_text": _map("SELECT code_3, popup FROM feat"),
    "point_features": _map(f"""
SELECT code_3, country, {r6('latitude')} AS latitude, {r6('longitude')} AS longitude, radius, popup,
       fill_color, color, {r6('fill_opacity')} AS fill_opacity FROM feat"""),
    "grid_cells": _map(f"""
SELECT CAST(floor(latitude / 30.0) AS BIGINT) AS cell_lat, CAST(floor(longitude / 30.0) AS BIGINT) AS cell_lon,
       count(*) AS n_points, {r6('avg(latitude)')} AS centroid_lat, {r6('avg(longitude)')} AS centroid_lon
FROM feat GROUP BY 1, 2"""),
    "train_test_split": _ser(f"""
SELECT series, {_month()}, {r6('value')} AS value, position, split FROM sp"""),
    "train_test_split_by_date": _ser(f"""
SELECT series, {_month()}, {r6('value')} AS value,
       CASE WHEN month <= DATE '2000-12-01' THEN 'train' ELSE 'test' END AS split
FROM ml WHERE month <= DATE '2001-10-01'"""),
    "seasonal_difference": _ser(f"""
SELECT series, {_month()}, {r6('value')} AS value,
       {r6('value - lag(value, 1) OVER w - lag(value, 12) OVER w + lag(value, 13) OVER w')} AS diff
FROM ml WINDOW w AS (PARTITION BY series ORDER BY month)"""),
    "lag_features": _ser(f"""
SELECT series, {_month()}, {r6('value')} AS value, {r6('lag(value, 1) OVER w')} AS lag_1,
       {r6('lag(value, 12) OVER w')} AS lag_12, {r6('lag(value, 13) OVER w')} AS lag_13
FROM ml WINDOW w AS (PARTITION BY series ORDER BY month)"""),
    "month_axis": sql([], f"""
WITH b AS (SELECT CAST(min(l_shipdate) AS DATE) AS s, CAST(max(l_shipdate) AS DATE) AS e FROM lineitem),
m AS (SELECT CAST(unnest(generate_series(CAST(date_trunc('month', s) AS TIMESTAMP),
                                         CAST(date_trunc('month', e - INTERVAL 1 DAY) AS TIMESTAMP),
                                         INTERVAL 1 MONTH)) AS DATE) AS month FROM b)
SELECT row_number() OVER (ORDER BY month) AS idx, {_month()}, strftime(month, '%b-%y') AS label FROM m"""),
    "fahrenheit_to_celsius": sql(["monthly"], f"""
SELECT CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month,
       {r6('(temperature - 32) * (CAST(5 AS DOUBLE) / 9)')} AS temperature_c FROM monthly"""),
    "holdout_compare": _ser(f"""
SELECT series, {_month()}, {r6('actual')} AS actual, {r6('predicted')} AS predicted FROM naive"""),
    "arma_start": _arma_start(),
    "holdout_mse": _ser(f"""
SELECT series, {r6('avg(pow(actual - predicted, 2))')} AS mse, count(*) AS n_months
FROM naive GROUP BY series"""),
    "indicator_min_present": _ind(f"""
SELECT country_name AS "Country Name", country_id AS "Country Code",
       '{INDICATOR_NAME}' AS "Indicator Name", '{INDICATOR_CODE}' AS "Indicator Code",
       {_YEAR_COLUMNS}
FROM kc GROUP BY country_name, country_id"""),
    "indicator_pair_distance": _ind(f"""
SELECT code_a, code_b, n_shared, {r6('distance')} AS distance FROM pd"""),
    "indicator_knn_imputed": _ind(f"""
SELECT country_id AS "Country Code", CAST(year AS BIGINT) AS "Year", {r6('imputed')} AS OrderValue,
       n_donors FROM fill"""),
    "indicator_long": _ind(f"""
SELECT country_name AS "Country Name", country_id AS "Country Code", CAST(year AS BIGINT) AS "Year",
       {r6('value')} AS OrderValue FROM cells WHERE value IS NOT NULL"""),
    "indicator_cleaned": _ind(f"""
SELECT * FROM (
  SELECT k.country_name AS "Country Name", k.country_id AS "Country Code", CAST(k.year AS BIGINT) AS "Year",
         {r6('coalesce(k.value, f.imputed)')} AS OrderValue
  FROM kc k LEFT JOIN fill f ON f.country_id = k.country_id AND f.year = k.year) x
WHERE OrderValue IS NOT NULL"""),
    "ridge_three_factor": _ridge_three_factor(),
    "ridge_predictions": _ridge_predictions(),
    "ridge_tests": _ridge_tests(),
}
