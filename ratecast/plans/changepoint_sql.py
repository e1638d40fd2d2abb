"""DuckDB CTEs of the changepoint model: the same sums, descent and elimination, set by set."""

from __future__ import annotations

import math

from ratecast.operators.changepoint import CHANGEPOINTS, COLUMNS, FLEXIBILITY, ORDERS, RANGE, SEASONAL_SCALE, SWEEPS, TINY, WEEK
from ratecast.plans.sql import epoch_s


def _d(x: float) -> str:
    return f"{x!r}::DOUBLE"


def _waves(e: str) -> list[str]:
    out = []
    for period, order in ORDERS:
        held = f"(CASE WHEN e1 - e0 >= {2 * period} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"
        for k in range(1, order + 1):
            angle = f"((({e}) % {period} + {period}) % {period})::DOUBLE * {_d(2.0 * math.pi * k / period)}"
            out += [f"sin({angle}) * {held}", f"cos({angle}) * {held}"]
    return out


def season(e: str, beta: str = "beta") -> str:
    return "(" + " + ".join(f"{beta}[{i + 1}] * {x}" for i, x in enumerate(_waves(e))) + ")"


CELL = f"least(floor(greatest(t, 0.0) * {_d(CHANGEPOINTS / RANGE)}), {CHANGEPOINTS})::INT"
AT = "(icpt[c + 1] + slope[c + 1] * t)"


def _s(j: str) -> str:
    """Scaled time of candidate j."""
    return f"({j} * {_d(RANGE)} / {CHANGEPOINTS})"


def rows_ctes(src: str = "train") -> str:
    span = "(e1 - e0)::DOUBLE"
    return (f"cp_raw AS (SELECT symbol, ds, {epoch_s('ds')} AS e, y FROM {src}), "
            "cp_scale AS MATERIALIZED (SELECT symbol, min(e) AS e0, max(e) AS e1, CASE WHEN max(abs(y)) > 0 THEN max(abs(y)) ELSE 1.0 END AS ymax "
            "FROM cp_raw WHERE y IS NOT NULL AND isfinite(y) GROUP BY symbol), "
            f"cp_rows AS MATERIALIZED (SELECT symbol, e, e0, e1, y / ymax AS z, CASE WHEN e1 > e0 THEN (e - e0)::DOUBLE / {span} ELSE 0.0::DOUBLE END AS t "
            "FROM cp_raw JOIN cp_scale USING (symbol) WHERE y IS NOT NULL AND isfinite(y))")


def trend_ctes(r: int, factor: str = "1.0::DOUBLE", sigma: str | None = None, join: str = "") -> str:
    """Level, slope and breaks of round r: ``cp_t{r}(symbol, slope, icpt, delta, sigma2)``."""
    n = f"cp{r}"
    step = (f"list_reduce(list_prepend(list_transform(range({CHANGEPOINTS}), lambda x: 0.0::DOUBLE), "
            f"list_transform(range({SWEEPS * CHANGEPOINTS}), lambda x: [(x % {CHANGEPOINTS})::DOUBLE])), "
            f"lambda th, e: list_transform(th, lambda x, i: CASE WHEN i - 1 <> e[1] THEN x WHEN gram[i][i] <= {_d(TINY)} * n THEN 0.0::DOUBLE ELSE "
            "sign(goal[i] - list_dot_product(gram[i], th) + gram[i][i] * x) * "
            "greatest(abs(goal[i] - list_dot_product(gram[i], th) + gram[i][i] * x) - lam, 0.0::DOUBLE) / gram[i][i] END))")
    cells = f"range(0, {CHANGEPOINTS + 1})"
    return ", ".join([
        f"{n}_w AS (SELECT symbol, {CELL} AS c, z, t, {factor} AS s FROM cp_rows {join})",
        f"{n}_m AS (SELECT symbol, c, sum(s * s) AS w, sum(s * s * t) AS t1, sum(s * s * t * t) AS t2, sum(s * z) AS y, sum(s * z * t) AS ty, "
        f"sum(z * z) AS zz, count(*) AS n FROM {n}_w GROUP BY symbol, c)",
        f"{n}_a AS MATERIALIZED (SELECT symbol, j, sum(w) AS w, sum(t1) AS t1, sum(t2) AS t2, sum(y) AS y, sum(ty) AS ty FROM "
        f"(SELECT symbol, unnest(range(0, c + 1)) AS j, w, t1, t2, y, ty FROM {n}_m) GROUP BY symbol, j)",
        f"{n}_0 AS (SELECT a.symbol, w, t1, t2, y, ty, w * t2 - t1 * t1 AS det, w * t2 - t1 * t1 > {_d(TINY)} * w * t2 AS line, q.zz, q.n::DOUBLE AS n FROM {n}_a a "
        f"JOIN (SELECT symbol, sum(zz) AS zz, sum(n) AS n FROM {n}_m GROUP BY symbol) q ON q.symbol = a.symbol WHERE a.j = 0)",
        f"{n}_i AS (SELECT symbol, n, zz, y, ty, CASE WHEN line THEN t2 / det ELSE 1.0 / w END AS p, CASE WHEN line THEN -t1 / det ELSE 0.0 END AS q, "
        f"CASE WHEN line THEN w / det ELSE 0.0 END AS o FROM {n}_0)",
        f"{n}_b AS MATERIALIZED (SELECT *, p * y + q * ty AS m0, q * y + o * ty AS k0, greatest(zz - ((p * y + q * ty) * y + (q * y + o * ty) * ty), 0.0) / n AS line_var FROM {n}_i)",
        f"{n}_h AS MATERIALIZED (SELECT b.symbol, g.j, coalesce(w, 0.0) AS w, coalesce(t1, 0.0) AS t1, coalesce(t2, 0.0) AS t2, coalesce(a.y, 0.0) AS y, coalesce(a.ty, 0.0) AS ty, "
        f"coalesce(t1 - {_s('g.j')} * w, 0.0) AS u, coalesce(t2 - {_s('g.j')} * t1, 0.0) AS v FROM {n}_b b CROSS JOIN range(1, {CHANGEPOINTS + 1}) AS g(j) "
        f"LEFT JOIN {n}_a a ON a.symbol = b.symbol AND a.j = g.j)",
        f"{n}_goal AS (SELECT h.symbol, list(h.ty - {_s('h.j')} * h.y - (h.u * m0 + h.v * k0) ORDER BY h.j) AS goal, list(h.u ORDER BY h.j) AS us, list(h.v ORDER BY h.j) AS vs "
        f"FROM {n}_h h JOIN {n}_b b ON b.symbol = h.symbol GROUP BY h.symbol)",
        f"{n}_g AS (SELECT i.symbol, i.j AS i, list(l.t2 - ({_s('i.j')} + {_s('k.j')}) * l.t1 + {_s('i.j')} * {_s('k.j')} * l.w "
        f"- (i.u * (p * k.u + q * k.v) + i.v * (q * k.u + o * k.v)) ORDER BY k.j) AS r "
        f"FROM {n}_h i JOIN {n}_h k ON k.symbol = i.symbol JOIN {n}_h l ON l.symbol = i.symbol AND l.j = greatest(i.j, k.j) JOIN {n}_b b ON b.symbol = i.symbol GROUP BY i.symbol, i.j)",
        f"{n}_q AS MATERIALIZED (SELECT b.symbol, n, p, q, o, m0, k0, goal, us, vs, {sigma or 'line_var'} AS sigma2, {sigma or 'line_var'} / {_d(FLEXIBILITY)} AS lam, gram FROM {n}_b b "
        f"JOIN {n}_goal USING (symbol) JOIN (SELECT symbol, list(r ORDER BY i) AS gram FROM {n}_g GROUP BY symbol) USING (symbol)" + (" JOIN cp_sigma USING (symbol)" if sigma else "") + ")",
        f"{n}_d AS MATERIALIZED (SELECT *, {step} AS delta FROM {n}_q)",
        f"{n}_l AS (SELECT *, m0 - (p * list_dot_product(us, delta) + q * list_dot_product(vs, delta)) AS m, k0 - (q * list_dot_product(us, delta) + o * list_dot_product(vs, delta)) AS k FROM {n}_d)",
        f"cp_t{r} AS MATERIALIZED (SELECT symbol, sigma2, delta, list_transform({cells}, lambda c: k + coalesce(list_sum(delta[1:c]), 0.0)) AS slope, "
        f"list_transform({cells}, lambda c: m - coalesce(list_sum(list_transform(delta[1:c], lambda x, j: x * {_s('j')})), 0.0)) AS icpt FROM {n}_l)",
    ])


def season_ctes(r: int) -> str:
    """Seasonal coefficients given the trend of round r: ``cp_s{r}(symbol, beta, sigma2)``."""
    n = f"cs{r}"
    x = _waves("e")
    out = [f"{n}_r AS (SELECT symbol, e, e0, e1, z, {AT} AS g FROM (SELECT cp_rows.*, {CELL} AS c FROM cp_rows) JOIN cp_t{r} USING (symbol))",
           f"{n}_p AS (SELECT symbol, any_value(e0) AS e0, any_value(e1) AS e1, ((e % {WEEK}) + {WEEK}) % {WEEK} AS e, sum(g * g) AS gg, sum(g * (z - g)) AS gr, "
           f"sum((z - g) * (z - g)) AS rr, count(*) AS n FROM {n}_r GROUP BY symbol, ((e % {WEEK}) + {WEEK}) % {WEEK})",
           f"{n}_x AS MATERIALIZED (SELECT symbol, gg, gr, [{', '.join(x)}] AS x FROM {n}_p)",
           f"{n}_b AS (SELECT symbol, i, sum(gr * x[i]) AS v FROM {n}_x, range(1, {COLUMNS + 1}) AS a(i) GROUP BY symbol, i)",
           f"{n}_a AS MATERIALIZED (SELECT symbol, i, j, sum(gg * x[i] * x[j]) AS v FROM {n}_x, range(1, {COLUMNS + 1}) AS a(i), range(1, {COLUMNS + 1}) AS b(j) GROUP BY symbol, i, j)",
           f"{n}_0 AS MATERIALIZED (SELECT symbol, i, j, v + CASE WHEN i = j THEN sigma2 / {_d(SEASONAL_SCALE ** 2)} + {_d(TINY)} ELSE 0.0 END AS v FROM {n}_a JOIN cp_t{r} USING (symbol) "
           f"UNION ALL SELECT symbol, i, {COLUMNS + 1}, v FROM {n}_b)"]
    for k in range(1, COLUMNS + 1):
        a = f"{n}_{k - 1}"
        out.append(f"{n}_{k} AS MATERIALIZED (SELECT a.symbol, a.i, a.j, CASE WHEN a.i = {k} THEN a.v / p.v ELSE a.v - c.v / p.v * r.v END AS v FROM {a} a "
                   f"JOIN {a} p ON p.symbol = a.symbol AND p.i = {k} AND p.j = {k} JOIN {a} c ON c.symbol = a.symbol AND c.i = a.i AND c.j = {k} "
                   f"JOIN {a} r ON r.symbol = a.symbol AND r.i = {k} AND r.j = a.j)")
    out += [f"{n}_beta AS MATERIALIZED (SELECT symbol, i, v FROM {n}_{COLUMNS} WHERE j = {COLUMNS + 1})",
            f"{n}_gain AS (SELECT symbol, sum(v) AS v FROM (SELECT a.symbol, a.v * b.v * c.v AS v FROM {n}_a a JOIN {n}_beta b ON b.symbol = a.symbol AND b.i = a.i "
            f"JOIN {n}_beta c ON c.symbol = a.symbol AND c.i = a.j UNION ALL SELECT b.symbol, -2 * b.v * c.v FROM {n}_b b JOIN {n}_beta c ON c.symbol = b.symbol AND c.i = b.i) GROUP BY symbol)",
            f"cp_s{r} AS MATERIALIZED (SELECT symbol, beta, greatest(rr + g.v, 0.0) / n AS sigma2 FROM (SELECT symbol, list(v ORDER BY i) AS beta FROM {n}_beta GROUP BY symbol) "
            f"JOIN (SELECT symbol, sum(rr) AS rr, sum(n)::DOUBLE AS n FROM {n}_p GROUP BY symbol) USING (symbol) JOIN {n}_gain g USING (symbol))"]
    return ", ".join(out)


def fit_ctes(src: str = "train") -> list[str]:
    """Two rounds: ``cp_fit(symbol, e0, e1, ymax, slope, icpt, delta, beta, sigma2)``."""
    return [rows_ctes(src), trend_ctes(1), season_ctes(1), "cp_sigma AS (SELECT symbol, sigma2 AS sigma_before FROM cp_s1)",
            trend_ctes(2, factor=f"1.0 + {season('e')}", sigma="sigma_before", join="JOIN cp_s1 USING (symbol)"), season_ctes(2),
            "cp_fit AS MATERIALIZED (SELECT symbol, e0, e1, ymax, slope, icpt, delta, beta, cp_s2.sigma2 AS sigma2 FROM cp_scale JOIN cp_t2 USING (symbol) JOIN cp_s2 USING (symbol))"]


def scored_cte(src: str, name: str = "cp_scored") -> str:
    """``src``: symbol, ds, y of history and future."""
    return (f"{name}_0 AS (SELECT x.symbol, ds, y, e, f.* EXCLUDE (symbol), CASE WHEN e1 > e0 THEN (e - e0)::DOUBLE / (e1 - e0)::DOUBLE ELSE 0.0::DOUBLE END AS t "
            f"FROM (SELECT symbol, ds, y, {epoch_s('ds')} AS e FROM {src}) x JOIN cp_fit f ON f.symbol = x.symbol), "
            f"{name}_1 AS (SELECT *, {CELL} AS c FROM {name}_0), "
            f"{name} AS (SELECT symbol, ds, y, ymax * {AT} AS trend, {season('e')} AS seasonal, ymax * sqrt(sigma2) AS sd FROM {name}_1)")

