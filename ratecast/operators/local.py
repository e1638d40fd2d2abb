"""Seasonal-trend decomposition by local regression (M6, ``decompose_time_series``).

A series is split into a trend that may turn anywhere, a seasonal part that may
change from cycle to cycle, and a remainder, by repeated smoothing:

1. the detrended values of each phase of the period (a cycle-subseries) are smoothed over the cycles;
2. what the smoothed subseries hold of the level, their mean over a full period, is taken off: the seasonal part;
3. the values without it are smoothed over time: the trend.

After INNER turns, values far from the fit get less weight (bisquare of the
remainder over six times its median) and the turns are run again, OUTER times, so single outliers move
little (one that outweighs all neighbours of its phase in the first turn still does). Smoothing is local linear regression with tricube weights
in a fixed distance; a missing hour is simply not among the neighbours.

Spark deals the series; a series (one row an hour) is one group, smoothed in arrays: five correlations over its hours a smoothing. (As window frames with higher-order functions the same sums took 100 times as long.)

Defined cases: null, NaN and infinite values take no part but get trend and seasonal part; several rows of one hour each count;
a weight is never below FLOOR, so a neighbourhood of outliers is smoothed as it is; near the
ends, where no full period lies around a row, the level of the last row before that has one is taken, else of the
first after (that of the whole series if none has); a series without any value has null parts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecast.functions import epoch_seconds
from ratecast.operators.forecast import cluster_series

# Hours of a period, cycles to each side for the seasonal part, hours to each side for the trend.
PERIOD, SEASON_REACH, TREND_REACH = 24, 3, 23
INNER, OUTER = 2, 2
FLOOR = 1e-6

PARTS = "symbol string, ds timestamp_ntz, y double, trend double, seasonal double, remainder double, weight double"


def local_line(at: np.ndarray, value: np.ndarray, weight: np.ndarray, reach: int) -> np.ndarray:
    """Value at each row of the line fitted to the rows within ``reach`` of it; ``at`` ascends, NaN values take no part.

    The five sums of a fit are sums of weight and weighted value by distance: rows are added up by place, and a correlation
    over the places gives the sums around each. Places between rows far apart are left out.
    """
    n = len(at)
    if not n:
        return np.zeros(0)
    known = np.isfinite(value)
    w = np.where(known, weight, 0.0)
    # runs farther apart than any neighbours need only ``reach`` empty places between them
    gap = np.minimum(np.diff(at), reach + 1)
    place = np.concatenate(([0], np.cumsum(gap)))
    size = int(place[-1]) + 1
    ws, vs = np.bincount(place, w, size), np.bincount(place, np.where(known, w * np.where(known, value, 0.0), 0.0), size)
    d = np.arange(-reach, reach + 1).astype(float)
    u = (1.0 - (np.abs(d) / (reach + 1.0)) ** 3) ** 3
    around = lambda x, k: np.convolve(x, k[::-1])[reach:reach + size][place]
    s0, s1, s2 = around(ws, u), around(ws, u * d), around(ws, u * d * d)
    t0, t1 = around(vs, u), around(vs, u * d)
    det = s0 * s2 - s1 * s1
    line = det > 1e-9 * s0 * s2
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(line, (s2 * t0 - s1 * t1) / np.where(line, det, 1.0), np.where(s0 > 0, t0 / s0, np.nan))


def period_level(at: np.ndarray, smooth: np.ndarray, period: int) -> np.ndarray:
    """Mean over the full period around each row: hours half a period away on both sides count half if the period is even."""
    known = np.isfinite(smooth)
    sums = np.concatenate(([0.0], np.cumsum(np.where(known, smooth, 0.0))))
    counts = np.concatenate(([0], np.cumsum(known)))
    half = period // 2

    def within(reach: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = np.searchsorted(at, at - reach, "left"), np.searchsorted(at, at + reach, "right")
        return sums[hi] - sums[lo], counts[hi] - counts[lo]

    total, n = within(half)
    full = n >= period if period % 2 else n > period
    if not period % 2:
        inner, m = within(half - 1)
        total, n = total + inner, n + m
    level = np.where(full, total / np.maximum(n, 1), np.nan)
    if not full.any():
        return np.full(len(at), smooth[known].mean() if known.any() else np.nan)
    before = np.maximum.accumulate(np.where(full, np.arange(len(at)), -1))
    return np.where(before >= 0, level[before], level[np.argmax(full)])


def decompose_series(pos: np.ndarray, y: np.ndarray, period: int = PERIOD, season_reach: int = SEASON_REACH, trend_reach: int = TREND_REACH,
                     inner: int = INNER, outer: int = OUTER) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(trend, seasonal, remainder, weight) of one series; ``pos`` ascends, NaN values take no part."""
    n = len(pos)
    phase, cycle = pos % period, pos // period
    # cycle-subseries end to end, farther apart than any neighbours
    place = phase * (int(cycle.max() - cycle.min()) + 2 * season_reach + 2) + cycle if n else pos
    order = np.argsort(place, kind="stable")
    back = np.argsort(order, kind="stable")
    trend, weight, seasonal = np.zeros(n), np.ones(n), np.zeros(n)
    for turn in range(outer + 1):
        for _ in range(inner):
            smooth = local_line(place[order], (y - trend)[order], weight[order], season_reach)[back]
            seasonal = smooth - period_level(pos, smooth, period)
            trend = local_line(pos, y - seasonal, weight, trend_reach)
        if turn < outer:
            rest = np.abs(y - trend - seasonal)
            known = np.isfinite(rest)
            middle = np.median(rest[known]) if known.any() else 0.0
            with np.errstate(invalid="ignore", divide="ignore"):
                share = rest / (6 * middle)
            kept = np.where(np.isnan(share), 1.0, np.where(share >= 1, 0.0, (1 - np.minimum(share, 1) ** 2) ** 2))
            weight = np.maximum(kept, FLOOR)
    return trend, seasonal, y - trend - seasonal, weight


def decompose_local(train: DataFrame, step_seconds: int = 3600, period: int = PERIOD, season_reach: int = SEASON_REACH, trend_reach: int = TREND_REACH,
                    inner: int = INNER, outer: int = OUTER, tasks: int | None = None) -> DataFrame:
    """``symbol, ds, y, trend, seasonal, remainder, weight`` of every row of ``train`` (``symbol, ds, y``)."""

    def split(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["pos", "y"])
        y = rows["y"].to_numpy(float)
        parts = decompose_series(rows["pos"].to_numpy(), np.where(np.isfinite(y), y, np.nan), period, season_reach, trend_reach, inner, outer)
        return rows[["symbol", "ds", "y"]].assign(**dict(zip(("trend", "seasonal", "remainder", "weight"), parts)))

    rows = cluster_series(train.select("symbol", "ds", "y"), tasks).withColumn("pos", F.floor(epoch_seconds("ds") / F.lit(int(step_seconds))).cast("long"))
    return rows.groupBy("symbol").applyInPandas(split, PARTS)
