"""DuckDB CTEs of the KPSS statistics and of the two Hannan-Rissanen stages."""

from __future__ import annotations

from ratecast.operators.arima import KPSS_LAGS, LONG, MAX_D, RIDGE

ORDERED = "PARTITION BY symbol ORDER BY ds"


def _lag(x: str, k: int) -> str:
    return f"lag({x}, {k}) OVER ({ORDERED})"


def centred_cte(src: str) -> str:
    return (f"ar_x AS MATERIALIZED (SELECT symbol, ds, y - avg(y) OVER (PARTITION BY symbol ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS x "
            f"FROM {src} WHERE y IS NOT NULL AND isfinite(y))")


def kpss_ctes(src: str = "train_ar") -> list[str]:
    """``kpss(symbol, d, n, kpss)``."""
    far = KPSS_LAGS + 1
    out = [centred_cte(src), "kd0 AS (SELECT symbol, ds, x AS w FROM ar_x)"]
    for d in range(1, MAX_D + 1):
        out.append(f"kd{d} AS (SELECT symbol, ds, w FROM (SELECT symbol, ds, w - {_lag('w', 1)} AS w FROM kd{d - 1}) WHERE w IS NOT NULL)")
    out.append("kw AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT {d} AS d, symbol, ds, w FROM kd{d}" for d in range(MAX_D + 1)) + ")")
    over = "PARTITION BY symbol, d ORDER BY ds"
    lags = ", ".join(f"w * lag(w, {k}) OVER ({over}) AS g{k}" for k in range(1, far + 1))
    out.append(f"kl AS (SELECT d, symbol, w, w * w AS g0, {lags}, sum(w) OVER ({over} ROWS UNBOUNDED PRECEDING) AS c, (row_number() OVER ({over}))::DOUBLE AS t FROM kw)")
    gammas = ", ".join(f"coalesce(sum(g{k}), 0) / count(*) - avg(w) * avg(w) AS g{k}" for k in range(far + 1))
    out.append(f"ks AS (SELECT symbol, d, count(*) AS n, avg(w) AS m, sum(c * c) - 2 * avg(w) * sum(t * c) + avg(w) * avg(w) * sum(t * t) AS squares, {gammas} FROM kl GROUP BY symbol, d)")
    out.append("kr AS (SELECT *, CASE WHEN g0 > 0 THEN least(greatest(g1 / g0, -(1 - 2 / sqrt(n))), 1 - 2 / sqrt(n)) ELSE 0.0 END AS rho, "
               f"least(floor(4 * pow(n / 100.0::DOUBLE, 0.25::DOUBLE)), {KPSS_LAGS}) AS width FROM ks)")
    white = [f"((1 + rho * rho) * g{k} - rho * (g{k + 1} + g{abs(k - 1)}))" for k in range(far)]
    total = white[0] + "".join(f" + 2 * greatest(1 - {k}.0::DOUBLE / (width + 1), 0.0) * {white[k]}" for k in range(1, far))
    out.append(f"kv AS (SELECT *, greatest({total}, 0.001::DOUBLE * {white[0]}) / ((1 - rho) * (1 - rho)) AS long_run FROM kr)")
    out.append(f"kpss AS (SELECT symbol, d, n, CASE WHEN g0 > {RIDGE * RIDGE!r}::DOUBLE AND long_run > 0 AND n > 3 THEN squares / (n::DOUBLE * n * long_run) ELSE 0.0 END AS kpss FROM kv)")
    return out


def _solved(name: str, rows: str, columns: list[str], target: str) -> list[str]:
    """``name(symbol, a)``: least squares of ``target`` on ``columns`` by set-wise elimination; ``name_s``: gram, yy, n."""
    k = len(columns)
    out = [f"{name}_x AS MATERIALIZED (SELECT symbol, {target} AS y, [{', '.join(columns)}] AS x FROM {rows})",
           f"{name}_g AS MATERIALIZED (SELECT symbol, i, j, sum(x[i] * CASE WHEN j = {k + 1} THEN y ELSE x[j] END) AS v FROM {name}_x, range(1, {k + 1}) AS a(i), range(1, {k + 2}) AS b(j) GROUP BY symbol, i, j)",
           f"{name}_0 AS MATERIALIZED (SELECT symbol, i, j, CASE WHEN i = j THEN v * (1 + {RIDGE!r}::DOUBLE) + {RIDGE!r}::DOUBLE ELSE v END AS v FROM {name}_g)"]
    for p in range(1, k + 1):
        a = f"{name}_{p - 1}"
        out.append(f"{name}_{p} AS MATERIALIZED (SELECT a.symbol, a.i, a.j, CASE WHEN a.i = {p} THEN a.v / p.v ELSE a.v - c.v / p.v * r.v END AS v FROM {a} a "
                   f"JOIN {a} p ON p.symbol = a.symbol AND p.i = {p} AND p.j = {p} JOIN {a} c ON c.symbol = a.symbol AND c.i = a.i AND c.j = {p} "
                   f"JOIN {a} r ON r.symbol = a.symbol AND r.i = {p} AND r.j = a.j)")
    out.append(f"{name} AS MATERIALIZED (SELECT symbol, list(v ORDER BY i) AS a FROM {name}_{k} WHERE j = {k + 1} GROUP BY symbol)")
    return out


def hannan_rissanen_ctes(p: int, q: int, src: str = "train_ar") -> list[str]:
    """``hr(symbol, const, phi, theta, sigma2, n)`` of the undifferenced series."""
    order = max(p, q, 1)
    long = [f"w{k}" for k in range(1, LONG + 1)]
    out = [centred_cte(src), f"hl AS MATERIALIZED (SELECT symbol, ds, x AS w, {', '.join(f'{_lag('x', k)} AS w{k}' for k in range(1, LONG + 1))} FROM ar_x)",
           f"hf AS (SELECT * FROM hl WHERE w{LONG} IS NOT NULL)", *_solved("h1", "hf", ["1.0::DOUBLE", *long], "w")]
    guess = "a[1] + " + " + ".join(f"a[{k + 1}] * w{k}" for k in range(1, LONG + 1))
    out.append(f"he AS MATERIALIZED (SELECT l.symbol, ds, w, CASE WHEN w{LONG} IS NOT NULL THEN w - ({guess}) END AS e FROM hl l LEFT JOIN h1 ON h1.symbol = l.symbol)")
    lags = [f"{_lag(x, k)} AS {x}{k}" for x in ("w", "e") for k in range(1, order + 1)]
    out.append(f"h2r AS (SELECT * FROM (SELECT symbol, w, {', '.join(lags)} FROM he) WHERE e{order} IS NOT NULL)")
    columns = ["1.0::DOUBLE", *[f"w{k}" for k in range(1, p + 1)], *[f"e{k}" for k in range(1, q + 1)]]
    out += _solved("h2", "h2r", columns, "w")
    out.append(f"hr AS (SELECT h2.symbol, a[1] AS const, a[2:{p + 1}] AS phi, a[{p + 2}:{p + q + 1}] AS theta, greatest(yy - list_dot_product(a, b), 0.0) / n AS sigma2, n FROM h2 "
               f"JOIN (SELECT symbol, list(v ORDER BY i) AS b FROM h2_g WHERE j = {len(columns) + 1} GROUP BY symbol) USING (symbol) "
               "JOIN (SELECT symbol, sum(y * y) AS yy, count(*) AS n FROM h2_x GROUP BY symbol) USING (symbol))")
    return out
