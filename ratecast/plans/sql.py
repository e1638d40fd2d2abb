"""DuckDB SQL fragments for the oracles.

They restate each operator's meaning directly in SQL over the same parquet
views, independently of the Spark code: CTE text is composed here and the
registry pairs it with the Spark query of the same name.
"""

from __future__ import annotations


def epoch_s(x: str) -> str:
    """Whole epoch seconds of a TIMESTAMP, rounded down (exact integer arithmetic)."""
    us = f"epoch_us({x})"
    return f"(({us} - (({us} % 1000000) + 1000000) % 1000000) // 1000000)"


def ts_of(secs: str) -> str:
    return f"make_timestamp(CAST({secs} AS BIGINT) * 1000000)"


def tumble(x: str, width: int) -> str:
    """Bucket start, truncating toward zero like SQL DIV."""
    s = epoch_s(x)
    return ts_of(f"({s} - ({s} % {int(width)}))")


def date_str(x: str) -> str:
    return f"strftime({x}, '%Y%m%d%H%M%S')"


def ticks_cte(symbol: str = "event_type", name: str = "ticks", where: str | None = None) -> str:
    w = f" WHERE {where}" if where else ""
    return (f"{name} AS (SELECT ts AS \"timestamp\", CAST(event_id AS VARCHAR) AS request, "
            f"CAST({symbol} AS VARCHAR) AS symbol, value AS rate, {date_str('ts')} AS date_str FROM events{w})")


def hourly_cte(src: str = "ticks", name: str = "hourly", width: int = 3600) -> str:
    return (f"{name} AS (SELECT symbol, {tumble(chr(34) + 'timestamp' + chr(34), width)} AS tumble, "
            f"avg(rate) AS mean, count(*) AS count FROM {src} GROUP BY 1, 2)")


def grid_ctes(src: str = "hourly", name: str = "grid", width: int = 3600) -> str:
    return (
        f"{name}_bounds AS (SELECT min({epoch_s('tumble')}) AS lo, max({epoch_s('tumble')}) AS hi FROM {src}), "
        f"{name}_syms AS (SELECT DISTINCT symbol FROM {src}), "
        f"{name}_pos AS (SELECT s.symbol, unnest(generate_series(b.lo, b.hi, {int(width)})) AS p "
        f"FROM {name}_syms s, {name}_bounds b), "
        f"{name} AS (SELECT symbol, {ts_of('p')} AS tumble FROM {name}_pos)"
    )


def interp_ctes(src: str = "hourly", name: str = "interp", width: int = 3600, fill: str = "0.0") -> str:
    """Grid, left join and the two neighbour windows; output is the T5 schema."""
    # of rows of one bucket the one with the larger mean counts, a NULL mean as the smallest
    coord = "CASE WHEN count IS NOT NULL THEN {'x': pos, 'k': mean IS NOT NULL, 'y': mean} END"
    return (
        grid_ctes(src, f"{name}_grid", width) + ", "
        f"{name}_dense AS (SELECT g.symbol, g.tumble, h.mean, h.count, {epoch_s('g.tumble')} AS pos "
        f"FROM {name}_grid g LEFT JOIN {src} h ON g.symbol = h.symbol AND g.tumble = h.tumble), "
        f"{name}_nb AS (SELECT *, "
        f"max({coord}) OVER (PARTITION BY symbol ORDER BY pos RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prv, "
        f"min({coord}) OVER (PARTITION BY symbol ORDER BY pos RANGE BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt "
        f"FROM {name}_dense), "
        f"{name} AS (SELECT symbol, tumble, {date_str('tumble')} AS date_str, "
        f"CASE WHEN mean IS NOT NULL THEN mean WHEN prv IS NULL OR nxt IS NULL THEN {fill} "
        f"ELSE (nxt.y - prv.y) / (nxt.x - prv.x) * (pos - prv.x) + prv.y END AS intrp, "
        f"mean AS unfilled, coalesce(count, 0) AS count, pos, prv, nxt FROM {name}_nb)"
    )


def with_(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


def ieee_div(a: str, b: str) -> str:
    return (f"(CASE WHEN ({a}) IS NULL OR ({b}) IS NULL THEN NULL WHEN ({b}) = 0 THEN "
            f"(CASE WHEN ({a}) > 0 THEN 'Infinity'::DOUBLE WHEN ({a}) < 0 THEN '-Infinity'::DOUBLE "
            f"ELSE 'NaN'::DOUBLE END) ELSE ({a}) / ({b}) END)")


# Oracle form of the oracle_requests fixture: the rows the JSON path must yield,
# computed straight from orders x lineitem (no JSON involved).
REQ_LINES = (
    "req_lines AS (SELECT o.o_orderkey, o.o_orderdate, l.l_linenumber, l.l_partkey, l.l_suppkey, "
    "l.l_extendedprice FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey)"
)
REQ_KEPT = (
    "req_kept AS (SELECT * FROM req_lines WHERE o_orderkey % 5 = 3 AND o_orderkey % 11 <> 0)"
)


def viz_cte(name: str = "viz") -> str:
    rate = ieee_div("l_extendedprice", "CASE WHEN o_orderkey % 13 = 0 THEN 0.0 ELSE 100.0 END")
    return (
        f"{REQ_LINES}, {REQ_KEPT}, "
        f"{name} AS (SELECT o_orderdate AS block_timestamp, {tumble('o_orderdate', 3600)} AS block_timestamp_truncated, "
        f"o_orderkey AS oracle_request_id, 'S' || CAST(l_suppkey AS VARCHAR) AS symbol, {rate} AS rate "
        f"FROM req_kept WHERE o_orderkey % 7 <> 0)"
    )


def req_ticks_cte(src: str = "viz", name: str = "rticks", where: str | None = None) -> str:
    w = f" WHERE {where}" if where else ""
    return (f"{name} AS (SELECT block_timestamp_truncated AS \"timestamp\", CAST(oracle_request_id AS VARCHAR) AS request, "
            f"symbol, rate, {date_str('block_timestamp_truncated')} AS date_str FROM {src}{w})")


Z80 = "1.2815515655446004::DOUBLE"


def train_ctes(src: str = "interp", name: str = "train", dedupe: bool = False) -> str:
    """Holdout cut at max - 5 days, (symbol, ds, y), series with at least 3 rows.

    ``dedupe`` re-averages duplicate hours first (the AR models' input, A7)."""
    body = (f"SELECT symbol, tumble AS ds, avg(intrp) AS y FROM {src} WHERE tumble <= (SELECT c FROM {name}_cut) "
            f"GROUP BY symbol, tumble" if dedupe else
            f"SELECT symbol, tumble AS ds, intrp AS y FROM {src} WHERE tumble <= (SELECT c FROM {name}_cut)")
    return (
        f"{name}_cut AS (SELECT max(tumble) - INTERVAL 5 DAY AS c FROM {src}), "
        f"{name}_0 AS ({body}), "
        f"{name} AS (SELECT symbol, ds, y FROM (SELECT *, count(*) OVER (PARTITION BY symbol) AS n FROM {name}_0) "
        f"WHERE n >= 3)"
    )


def future_cte(src: str = "train", name: str = "fut", periods: int = 120, step: int = 3600) -> str:
    return (f"{name} AS (SELECT l.symbol, l.last + to_seconds(r.h * {int(step)}) AS ds, NULL::DOUBLE AS y "
            f"FROM (SELECT symbol, max(ds) AS last FROM {src} GROUP BY symbol) l "
            f"CROSS JOIN range(1, {int(periods) + 1}) AS r(h))")


def seasonal_ctes(src: str = "train", name: str = "seas", periods: int = 120) -> str:
    y = "y"
    fut = ""
    base = src
    if periods > 0:
        fut = future_cte(src, f"{name}_fut", periods) + ", "
        base = f"(SELECT * FROM {src} UNION ALL SELECT * FROM {name}_fut)"
    return (
        fut +
        f"{name}_1 AS (SELECT *, {epoch_s('ds')} / 3600.0::DOUBLE AS t FROM {base}), "
        f"{name}_2 AS (SELECT *, avg({y}) OVER ser + regr_slope({y}, t) OVER ser "
        f"* (t - avg(CASE WHEN y IS NOT NULL THEN t END) OVER ser) AS trend FROM {name}_1 WINDOW ser AS (PARTITION BY symbol ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)), "
        f"{name}_3 AS (SELECT *, coalesce(avg(CASE WHEN y IS NULL THEN NULL WHEN trend > 0 THEN y / trend "
        f"ELSE 1.0::DOUBLE END) OVER (PARTITION BY symbol, hour(ds) ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 1.0::DOUBLE) AS i_h FROM {name}_2), "
        f"{name}_4 AS (SELECT *, coalesce(avg(CASE WHEN y IS NULL THEN NULL WHEN trend * i_h > 0 THEN y / (trend * i_h) "
        f"ELSE 1.0::DOUBLE END) OVER (PARTITION BY symbol, dayofweek(ds) ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 1.0::DOUBLE) AS i_d FROM {name}_3), "
        f"{name}_5 AS (SELECT *, trend * i_h * i_d AS fitted FROM {name}_4), "
        f"{name} AS (SELECT *, stddev_samp(y - fitted) OVER ser AS sd FROM {name}_5 WINDOW ser AS (PARTITION BY symbol ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"
    )


def forecast_cte(src: str = "seas", name: str = "fc") -> str:
    return (f"{name} AS (SELECT symbol, ds, y, fitted AS yhat, fitted - {Z80} * sd AS yhat_lower, "
            f"fitted + {Z80} * sd AS yhat_upper FROM {src})")


def ar1_ctes(src: str = "train_ar", name: str = "ar") -> str:
    st = "(phi_raw IS NOT NULL AND abs(phi_raw) < 1 AND n >= 3)"
    return (
        f"{name}_lag AS (SELECT symbol, ds, y, lag(y) OVER (PARTITION BY symbol ORDER BY ds) AS x FROM {src}), "
        f"{name}_p0 AS (SELECT symbol, regr_slope(y, x ORDER BY ds) AS phi_raw, regr_intercept(y, x ORDER BY ds) AS c_raw, "
        f"CAST(regr_count(y, x) AS BIGINT) AS n, regr_sxx(y, x ORDER BY ds) AS sxx, regr_syy(y, x ORDER BY ds) AS syy, "
        f"regr_sxy(y, x ORDER BY ds) AS sxy, avg(pow(y - x, 2) ORDER BY ds) AS rw_var, "
        f"arg_max(y, {{'d': ds, 'y': y}}) AS y_last, max(ds) AS ds_last FROM {name}_lag GROUP BY symbol), "
        f"{name}_params AS (SELECT symbol, n, y_last, ds_last, "
        f"CASE WHEN {st} THEN phi_raw ELSE 1.0::DOUBLE END AS phi, "
        f"CASE WHEN {st} THEN c_raw ELSE 0.0::DOUBLE END AS c, "
        f"CASE WHEN {st} THEN c_raw / (1.0::DOUBLE - phi_raw) END AS mu, "
        f"CASE WHEN {st} THEN (syy - sxy * sxy / sxx) / (n - 2) ELSE rw_var END AS sigma2, "
        f"{st} AS stationary FROM {name}_p0)"
    )


def explain_cte(params: str = "ar_params", src: str = "train_ar", name: str = "xf", periods: int = 120) -> str:
    point = "CASE WHEN stationary THEN mu + pow(phi, h) * (y_last - mu) ELSE y_last END"
    var = ("CASE WHEN stationary THEN sigma2 * (1.0::DOUBLE - pow(phi, 2 * h)) / (1.0::DOUBLE - phi * phi) "
           "ELSE sigma2 * h END")
    return (
        f"{name}_f AS (SELECT symbol, ds_last + to_seconds(CAST(r.h AS BIGINT) * 3600) AS time_series_timestamp, "
        f"{point} AS pt, {Z80} * sqrt({var}) AS half FROM "
        f"(SELECT *, CAST(h0 AS DOUBLE) AS h FROM {params} CROSS JOIN range(1, {int(periods) + 1}) AS r0(h0)) r), "
        f"{name} AS (SELECT symbol, ds AS time_series_timestamp, y AS time_series_data, "
        f"NULL::DOUBLE AS prediction_interval_lower_bound, NULL::DOUBLE AS prediction_interval_upper_bound FROM {src} "
        f"UNION ALL SELECT symbol, time_series_timestamp, pt, pt - half, pt + half "
        f"FROM {name}_f)"
    )


def fva_cte(fc: str = "fc", actual: str = "interp", name: str = "fva") -> str:
    """Forecast LEFT JOIN actuals of (max(ds) - 5 days, max(ds)]."""
    return (
        f"{name} AS (SELECT p.symbol, p.ds, {date_str('p.ds')} AS date_str, p.y, p.yhat, p.yhat_lower, p.yhat_upper, "
        f"b.intrp FROM {fc} p LEFT JOIN (SELECT * FROM {actual} WHERE tumble > "
        f"(SELECT max(ds) - INTERVAL 5 DAY FROM {fc}) AND tumble <= (SELECT max(ds) FROM {fc})) b "
        f"ON b.tumble = p.ds AND p.symbol = b.symbol)"
    )


def ava_cte(xf: str = "xf", actual: str = "interp", name: str = "ava") -> str:
    ts = "time_series_timestamp"
    cut = f"(SELECT max({ts}) - INTERVAL 5 DAY FROM {xf})"
    return (
        f"{name} AS (SELECT a.symbol, {ts}, {date_str(ts)} AS date_str, "
        f"CASE WHEN {ts} <= {cut} THEN time_series_data END AS y, "
        f"CASE WHEN {ts} > {cut} THEN time_series_data END AS yhat, "
        f"prediction_interval_lower_bound AS yhat_lower, prediction_interval_upper_bound AS yhat_upper, b.intrp, "
        f"time_series_data FROM {xf} a LEFT JOIN (SELECT * FROM {actual} WHERE tumble > {cut} "
        f"AND tumble <= (SELECT max({ts}) FROM {xf})) b ON b.tumble = a.{ts} AND a.symbol = b.symbol)"
    )


def model_base(symbol: str = "user_id") -> list[str]:
    """Ticks -> hourly -> interpolated table -> training frames (seasonal: as is; AR: hours re-averaged)."""
    return [ticks_cte(symbol), hourly_cte(), interp_ctes(), train_ctes(), train_ctes(name="train_ar", dedupe=True)]



def rounded(*cols: str) -> str:
    """Columns rounded to 6 decimals for the comparison (last bits of sums depend on the order of rows)."""
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)
