"""DuckDB CTEs of the local decomposition: the same windows, neighbours as lists."""

from __future__ import annotations

from ratecast.operators.local import FLOOR, INNER, OUTER, PERIOD, SEASON_REACH, TREND_REACH
from ratecast.plans.sql import epoch_s


def _line(src: str, name: str, out: str, keys: str, at: str, value: str, reach: int) -> str:
    w = f"pow(1 - pow(abs(e.p - {at}) / {reach + 1}.0::DOUBLE, 3), 3) * e.w"
    part = lambda x: f"list_sum(list_transform(near, lambda e: {w}{x}))"
    return (f"{name}_n AS (SELECT *, list({{'p': {at}, 'v': {value}, 'w': weight}}) FILTER (({value}) IS NOT NULL) OVER (PARTITION BY {keys} ORDER BY {at} "
            f"RANGE BETWEEN {reach} PRECEDING AND {reach} FOLLOWING) AS near FROM {src}), "
            f"{name}_s AS (SELECT * EXCLUDE (near), {part('')} AS s0, {part(f' * (e.p - {at})')} AS s1, {part(f' * (e.p - {at}) * (e.p - {at})')} AS s2, "
            f"{part(' * e.v')} AS t0, {part(f' * (e.p - {at}) * e.v')} AS t1 FROM {name}_n), "
            f"{name} AS MATERIALIZED (SELECT * EXCLUDE (s0, s1, s2, t0, t1), CASE WHEN s0 * s2 - s1 * s1 > 1e-9::DOUBLE * s0 * s2 THEN (s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1) "
            f"WHEN s0 > 0 THEN t0 / s0 END AS {out} FROM {name}_s)")


def ctes(src: str = "train") -> list[str]:
    """``ld(symbol, ds, y, trend, seasonal, remainder, weight)``."""
    half = PERIOD // 2
    out = [f"ld_0 AS (SELECT symbol, ds, y, y AS v, {epoch_s('ds')} // 3600 AS pos, ({epoch_s('ds')} // 3600) % {PERIOD} AS phase, ({epoch_s('ds')} // 3600) // {PERIOD} AS cycle, "
           f"0.0::DOUBLE AS trend, 1.0::DOUBLE AS weight FROM {src})"]
    now, k = "ld_0", 0
    time = "PARTITION BY symbol ORDER BY pos"
    for turn in range(OUTER + 1):
        for _ in range(INNER):
            k += 1
            out.append(_line(now, f"ld_{k}a", "smooth", "symbol, phase", "cycle", "v - trend", SEASON_REACH))
            ends, inner = f"OVER ({time} RANGE BETWEEN {half} PRECEDING AND {half} FOLLOWING)", f"OVER ({time} RANGE BETWEEN {half - 1} PRECEDING AND {half - 1} FOLLOWING)"
            out.append(f"ld_{k}b AS (SELECT * EXCLUDE (trend), CASE WHEN count(smooth) {ends} > {PERIOD} THEN (sum(smooth) {ends} + sum(smooth) {inner}) / "
                       f"(count(smooth) {ends} + count(smooth) {inner}) END AS level FROM ld_{k}a)")
            out.append(f"ld_{k}c AS (SELECT * EXCLUDE (level, smooth), smooth - coalesce(last_value(level IGNORE NULLS) OVER ({time} ROWS UNBOUNDED PRECEDING), "
                       f"last_value(level IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY pos DESC ROWS UNBOUNDED PRECEDING), avg(smooth) OVER (PARTITION BY symbol)) AS seasonal FROM ld_{k}b)")
            out.append(_line(f"ld_{k}c", f"ld_{k}d", "trend", "symbol", "pos", "v - seasonal", TREND_REACH))
            now = f"ld_{k}e"
            out.append(f"{now} AS (SELECT *, v - trend - seasonal AS remainder FROM ld_{k}d)")
            if not (turn == OUTER and _ == INNER - 1):
                again = f"ld_{k}f"
                last_inner = _ == INNER - 1
                if last_inner:
                    out.append(f"ld_{k}m AS (SELECT symbol, median(abs(remainder)) AS m FROM {now} GROUP BY symbol)")
                    out.append(f"ld_{k}w AS (SELECT e.* EXCLUDE (weight), abs(remainder) / (6 * m) AS share FROM {now} e JOIN ld_{k}m USING (symbol))")
                    out.append(f"{again} AS (SELECT * EXCLUDE (share, remainder, seasonal), greatest(CASE WHEN share IS NULL OR isnan(share) THEN 1.0 WHEN share >= 1 THEN 0.0 "
                               f"ELSE (1 - share * share) * (1 - share * share) END, {FLOOR!r}::DOUBLE) AS weight FROM ld_{k}w)")
                else:
                    out.append(f"{again} AS (SELECT * EXCLUDE (remainder, seasonal) FROM {now})")
                now = again
    out.append(f"ld AS (SELECT symbol, ds, y, trend, seasonal, remainder, weight FROM {now})")
    return out
