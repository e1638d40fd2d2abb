"""Local decomposition: planted parts, a brute-force version, outliers, gaps."""

import datetime as dt

import numpy as np
import pytest

from ratecast.operators import local as L

TRAIN = "symbol string, ds timestamp_ntz, y double"
START = dt.datetime(2024, 1, 1)


def brute_line(at, v, w, reach):
    out = []
    for x in at:
        near = [(p - x, a, (1 - (abs(p - x) / (reach + 1)) ** 3) ** 3 * b) for p, a, b in zip(at, v, w) if abs(p - x) <= reach and np.isfinite(a)]
        s0, s1, s2 = (sum(u * d ** k for d, _, u in near) for k in range(3))
        t0, t1 = (sum(u * d ** k * a for d, a, u in near) for k in range(2))
        det = s0 * s2 - s1 * s1
        out.append((s2 * t0 - s1 * t1) / det if near and det > 1e-9 * s0 * s2 else t0 / s0 if s0 > 0 else np.nan)
    return np.array(out)


def brute(pos, y, period, season_reach, trend_reach):
    trend, weight = np.zeros(len(y)), np.ones(len(y))
    for turn in range(3):
        for _ in range(2):
            smooth = np.empty(len(y))
            for ph in set(pos % period):
                some = np.flatnonzero(pos % period == ph)
                smooth[some] = brute_line(pos[some] // period, (y - trend)[some], weight[some], season_reach)
            level = np.full(len(y), np.nan)
            for i, x in enumerate(pos):
                ends = [s for p, s in zip(pos, smooth) if abs(p - x) <= period // 2 and np.isfinite(s)]
                inner = [s for p, s in zip(pos, smooth) if abs(p - x) < period // 2 and np.isfinite(s)]
                if period % 2 and len(ends) >= period:
                    level[i] = np.mean(ends)
                elif not period % 2 and len(ends) > period:
                    level[i] = (sum(ends) + sum(inner)) / (len(ends) + len(inner))
            full = np.flatnonzero(np.isfinite(level))
            for i in range(len(y)):
                if not np.isfinite(level[i]):
                    before = full[full < i]
                    level[i] = level[before[-1]] if len(before) else level[full[0]] if len(full) else np.nanmean(smooth)
            seasonal = smooth - level
            trend = brute_line(pos, y - seasonal, weight, trend_reach)
        if turn < 2:
            rest = np.abs(y - trend - seasonal)
            share = rest / (6 * np.nanmedian(rest))
            weight = np.where(np.isnan(share), 1.0, np.maximum(np.where(share >= 1, 0, (1 - share ** 2) ** 2), L.FLOOR))
    return trend, seasonal, y - trend - seasonal, weight


def frame(spark, series):
    rows = [(name, START + dt.timedelta(hours=int(i)), None if y is None else float(y)) for name, s in series.items() for i, y in s]
    return spark.createDataFrame(rows, TRAIN).repartition(4)


def collected(df):
    out = {}
    for r in df.orderBy("symbol", "ds", "y").collect():
        out.setdefault(r.symbol, []).append(r)
    return out


@pytest.mark.parametrize("period", [24, 7])
def test_against_brute_force_with_gaps(period):
    rng = np.random.default_rng(1)
    pos = np.concatenate((np.arange(1000, 1060), np.sort(rng.choice(np.arange(1060, 1240), 110, replace=False))))
    y = 10 + 0.05 * pos + 3 * np.sin(2 * np.pi * pos / period) + rng.normal(0, 0.5, len(pos))
    y[[20, 90]] += 40
    y[50] = np.nan
    got = L.decompose_series(pos, y, period, 2, 11)
    for a, b in zip(got, brute(pos, y, period, 2, 11)):
        assert np.allclose(a, b, atol=1e-8, equal_nan=True)


def test_planted_parts_are_returned_within_two_per_cent(spark):
    t = np.arange(24 * 40)
    trend = 100 + 20 * np.sin(2 * np.pi * t / (24 * 30)) + 0.02 * t
    season = 15 * np.sin(2 * np.pi * t / 24) + 5 * np.cos(4 * np.pi * t / 24)
    got = collected(L.decompose_local(frame(spark, {"a": list(enumerate(trend + season))})))["a"]
    inside = slice(24, -24)
    assert np.abs([r.trend for r in got] - trend)[inside].max() < 0.02 * (trend.max() - trend.min())
    assert np.abs([r.seasonal for r in got] - season)[inside].max() < 0.02 * (season.max() - season.min())
    assert max(abs(r.y - r.trend - r.seasonal - r.remainder) for r in got) < 1e-9


def test_outliers_do_not_move_the_fit(spark):
    rng = np.random.default_rng(2)
    t = np.arange(24 * 20)
    clean = 50 + 10 * np.sin(2 * np.pi * t / 24) + rng.normal(0, 0.3, len(t))
    dirty = clean.copy()
    at = rng.choice(len(t), 12, replace=False)
    dirty[at] += 15
    got = collected(L.decompose_local(frame(spark, {"clean": list(enumerate(clean)), "dirty": list(enumerate(dirty))})))
    moved = np.abs(np.array([r.trend + r.seasonal for r in got["clean"]]) - [r.trend + r.seasonal for r in got["dirty"]])
    assert np.median(moved) < 0.1 and np.quantile(moved, 0.97) < 1.0
    assert all(got["dirty"][i].weight <= 0.01 for i in at)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    series = {"one": [(0, 5.0)], "none": [(0, None), (1, nan)], "flat": [(i, 3.0) for i in range(60)], "short": [(0, 1.0), (5, 2.0), (9, inf), (12, None)],
              "twice": [(i, float(i % 24)) for i in range(100)] + [(30, 6.0)]}
    got = collected(L.decompose_local(frame(spark, series)))
    assert {k: len(v) for k, v in got.items()} == {k: len(v) for k, v in series.items()}
    assert all(abs(r.trend - 3) < 1e-9 and abs(r.seasonal) < 1e-9 for r in got["flat"])
    assert got["one"][0].trend == 5.0 and got["one"][0].seasonal == 0.0
    assert all(r.trend is None or np.isnan(r.trend) for r in got["none"])
    assert L.decompose_local(spark.createDataFrame([], TRAIN)).count() == 0


def test_smoothing_takes_a_few_vector_steps():
    """600 hours in the time of some correlations, whatever the reach; one step a neighbour took several times as long."""
    import time

    pos, y = np.arange(600), np.random.default_rng(0).normal(100, 30, 600)
    times = []
    for _ in range(9):
        t = time.perf_counter()
        L.local_line(pos, y, np.ones(600), 200)
        times.append(time.perf_counter() - t)
    one = time.perf_counter()
    for _ in range(5):
        np.convolve(y, np.ones(401))
    one = time.perf_counter() - one
    assert min(times) < 12 * one + 1e-3


def test_far_runs_do_not_meet():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=50), rng.normal(size=70)
    pos = np.concatenate((np.arange(50), 10 ** 9 + np.arange(70)))
    both = L.local_line(pos, np.concatenate((a, b)), np.ones(120), 23)
    assert np.allclose(both, np.concatenate((L.local_line(np.arange(50), a, np.ones(50), 23), L.local_line(np.arange(70), b, np.ones(70), 23))))
