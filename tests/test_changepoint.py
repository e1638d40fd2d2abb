"""Trend breaks, smooth seasonality and the widening band on series whose truth is known."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecast.operators import changepoint as C
from ratecast.operators import forecast as M

TRAIN = "symbol string, ds timestamp_ntz, y double"
START = dt.datetime(2024, 1, 1)


def frame(spark, series, start=START, step=dt.timedelta(hours=1)):
    rows = [(name, start + i * step, None if y is None else float(y)) for name, ys in series.items() for i, y in enumerate(ys)]
    return spark.createDataFrame(rows, TRAIN).repartition(5)


def test_a_planted_break_is_found_within_a_day(spark):
    """Both bends of a trend with noise: the fitted trend turns within a day of each, and nowhere else by much."""
    rng = np.random.default_rng(0)
    n = 24 * 60
    t = np.arange(n)
    at = {"up": 24 * 20, "down": 24 * 35}
    series = {name: 50 + 0.02 * t + (0.1 if name == "up" else -0.08) * np.maximum(t - b, 0) + rng.normal(0, 1.0, n) for name, b in at.items()}
    params = C.fit_changepoints(frame(spark, series), seasonal=False)
    found = {}
    for r in C.changes(params).collect():
        found.setdefault(r.symbol, []).append(((r.ds - START).total_seconds() / 3600, r.delta))
    for name, b in at.items():
        hours, deltas = np.array(found[name]).T
        centre = (hours * np.abs(deltas)).sum() / np.abs(deltas).sum()
        assert abs(centre - b) <= 24, (name, found[name])
        assert abs(deltas.sum() - (0.1 if name == "up" else -0.08)) < 0.01


def test_a_straight_line_has_no_breaks(spark):
    rng = np.random.default_rng(1)
    params = C.fit_changepoints(frame(spark, {"line": 10 + 0.5 * np.arange(900) + rng.normal(0, 3, 900)}), seasonal=False)
    r = params.select("delta", "slope", "ymax").collect()[0]
    assert np.abs(r.delta).max() < 0.03 * r.slope[0] and abs(sum(r.delta)) < 0.03 * r.slope[0]


def brute_trend(t, z, s, sigma2):
    """The penalised fit by many descent steps on the design matrix itself."""
    h = np.maximum(t[:, None] - C.S, 0) * s[:, None]
    u = np.column_stack((s, s * t))
    project = np.eye(len(t)) - u @ np.linalg.pinv(u)
    x, y = project @ h, project @ z
    delta = np.zeros(len(C.S))
    for _ in range(3000):
        for j in range(len(C.S)):
            q = x[:, j] @ x[:, j]
            r = x[:, j] @ (y - x @ delta) + q * delta[j]
            delta[j] = np.sign(r) * max(abs(r) - sigma2 / C.FLEXIBILITY, 0) / q
    return delta, np.linalg.lstsq(u, z - h @ delta, rcond=None)[0]


def test_trend_from_cell_sums_equals_the_design_matrix(spark):
    rng = np.random.default_rng(2)
    t = np.sort(rng.uniform(0, 1, 400))
    t[0], t[-1] = 0.0, 1.0
    s = 1 + 0.3 * rng.uniform(-1, 1, 400)
    z = s * (0.2 + 0.3 * t + 0.9 * np.maximum(t - 0.32, 0)) + rng.normal(0, 0.02, 400)
    cell = np.minimum(np.floor(t * C.CHANGEPOINTS / C.RANGE), C.CHANGEPOINTS).astype(int)
    m = np.zeros((1, C.CELLS, 5))
    for c, v in zip(cell, np.column_stack((s * s, s * s * t, s * s * t * t, s * z, s * z * t))):
        m[0, c] += v
    slope, icpt, delta, _ = C.solve_trend(m, np.array([z @ z]), np.array([400.0]), np.array([4e-4]), sweeps=3000)
    want, (level, k) = brute_trend(t, z, s, 4e-4)
    assert np.abs(delta[0] - want).max() < 1e-6
    g = icpt[0][cell] + slope[0][cell] * t
    assert np.abs(g - (level + k * t + np.maximum(t[:, None] - C.S, 0) @ want)).max() < 1e-6
    # the default number of sweeps is near that
    fast = C.solve_trend(m, np.array([z @ z]), np.array([400.0]), np.array([4e-4]))
    assert np.abs(fast[1][0][cell] + fast[0][0][cell] * t - g).max() < 0.01


def test_smooth_seasonality_beats_the_index_form_on_a_planted_wave(spark):
    """A daily and a weekly wave on a trend that bends: lower holdout error than one line times hour and weekday means."""
    rng = np.random.default_rng(3)
    n = 24 * 35
    t = np.arange(n + 120)
    wave = 1 + 0.3 * np.sin(2 * np.pi * t / 24) + 0.15 * np.cos(2 * np.pi * t / 168 + 1)
    series = {f"s{i}": (100 + 0.1 * t + (0.4 - 0.1 * i) * np.maximum(t - 24 * 12, 0)) * wave + rng.normal(0, 4, len(t)) for i in range(4)}
    train = frame(spark, {k: v[:n] for k, v in series.items()})
    truth = {(k, START + dt.timedelta(hours=int(i))): v[i] for k, v in series.items() for i in range(n, n + 120)}

    def rmse(fc):
        rows = fc.where("y IS NULL").collect()
        assert len(rows) == len(truth)
        return np.sqrt(np.mean([(r.yhat - truth[r.symbol, r.ds]) ** 2 for r in rows]))

    smooth, index = rmse(C.forecast_changepoint(train)), rmse(M.forecast_seasonal(train))
    assert smooth < 0.5 * index and smooth < 10, (smooth, index)


def test_seasonal_coefficients_solve_the_normal_equations(spark):
    """Against least squares on the design matrix, for a known trend."""
    rng = np.random.default_rng(4)
    n = 24 * 21
    t = np.arange(n)
    train = frame(spark, {"a": (100 + 0.05 * t) * (1 + 0.2 * np.sin(2 * np.pi * 3 * t / 24)) + rng.normal(0, 1, n)})
    rows, _ = C._fit_rows(train)
    trend = C.fit_changepoints(train, seasonal=False).select("symbol", "slope", "icpt", "sigma2")
    beta = np.array(C._season(rows, trend).collect()[0].beta)
    data = rows.join(trend, "symbol").select("e", "t", "z", C.trend_at(F.col("t")).alias("g"), *[w.alias(f"x{i}") for i, w in enumerate(C.waves(F.col("e")))]).toPandas()
    x = data[[f"x{i}" for i in range(C.COLUMNS)]].to_numpy() * data[["g"]].to_numpy()
    ridge = trend.collect()[0].sigma2 / C.SEASONAL_SCALE ** 2 + C.TINY
    want = np.linalg.solve(x.T @ x + ridge * np.eye(C.COLUMNS), x.T @ (data.z - data.g).to_numpy())
    assert np.abs(beta - want).max() < 1e-9
    assert abs(beta[4] - 0.2) < 0.01  # the planted wave: sine, three a day


def test_band_covers_its_share_of_simulated_futures():
    """Futures drawn by another generator from the same process: 80 % within 3 points, overall and at each end of the horizon."""
    rng = np.random.default_rng(5)
    periods, step, scale, sigma = 120, 1 / 600, 0.8, 0.02
    factor = 1 + 0.2 * np.sin(2 * np.pi * np.arange(1, periods + 1) / 24)
    inside = []
    for key in range(40):
        lower, upper = C.simulated_band(key * 7919, step, scale, sigma, factor, 0.8, 400)
        for _ in range(100):
            change = np.where(rng.uniform(size=periods) < C.CHANGEPOINTS * step, rng.laplace(0, scale, periods), 0)
            path = np.cumsum(np.cumsum(change)) * step * factor + rng.normal(0, sigma, periods)
            inside.append((lower <= path) & (path <= upper))
    share = np.array(inside).mean(0)
    assert abs(share.mean() - 0.8) < 0.03 and abs(share[:24].mean() - 0.8) < 0.03 and abs(share[-24:].mean() - 0.8) < 0.03


def test_band_widens_and_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(6)
    t = np.arange(24 * 30)
    series = {f"s{i}": 20 + np.cumsum(np.repeat(rng.normal(0, 0.05, 30), 24)) + rng.normal(0, 0.3, len(t)) for i in range(3)}
    train = frame(spark, series)
    a = sorted(map(tuple, C.forecast_changepoint(train.repartition(1), periods=60).where("y IS NULL").select("symbol", "ds", "yhat", "yhat_lower", "yhat_upper").collect()))
    b = sorted(map(tuple, C.forecast_changepoint(train.repartition(7, "ds"), periods=60).where("y IS NULL").select("symbol", "ds", "yhat", "yhat_lower", "yhat_upper").collect()))
    assert len(a) == 180
    for x, y in zip(a, b):
        assert x[:2] == y[:2] and np.allclose(x[2:], y[2:], rtol=1e-9)
        assert x[3] <= x[2] <= x[4]
    width = np.array([r[4] - r[3] for r in a]).reshape(3, 60)
    assert (width[:, -12:].mean(1) > 1.2 * width[:, :12].mean(1)).all()
    other = C.forecast_changepoint(train, periods=60, seed=1).where("y IS NULL").orderBy("symbol", "ds").collect()
    assert any(abs(x[3] - y.yhat_lower) > 1e-9 for x, y in zip(a, other))


def test_edge_cases(spark):
    """One time, one row, gaps, nulls, NaN, infinities, zeros, an empty table."""
    nan, inf = float("nan"), float("inf")
    series = {"one": [5.0], "zero": [0.0] * 50, "gaps": [1.0, None, nan, 4.0, inf, 6.0], "none": [None, None], "flat": [3.0] * 60}
    rows = C.forecast_changepoint(frame(spark, series), periods=3).collect()
    by = {}
    for r in rows:
        by.setdefault(r.symbol, []).append(r)
    assert set(by) == {"one", "zero", "gaps", "flat"}
    assert {k: len(v) for k, v in by.items()} == {"one": 4, "zero": 53, "gaps": 9, "flat": 63}
    assert all(np.isfinite([r.yhat, r.yhat_lower, r.yhat_upper]).all() for r in rows)
    assert all(abs(r.yhat - 5) < 1e-6 for r in by["one"]) and all(abs(r.yhat - 3) < 1e-6 for r in by["flat"]) and all(abs(r.yhat) < 1e-9 for r in by["zero"])
    assert C.forecast_changepoint(spark.createDataFrame([], TRAIN)).count() == 0


def test_a_long_series_is_summed_in_many_tasks(spark):
    """The fit's aggregates are combined before their shuffle, and no stage gathers a series."""
    train = frame(spark, {"a": np.arange(500.0)})
    rows, _ = C._fit_rows(train)
    plan = C._moments(rows.withColumn("s", F.lit(1.0)))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Window" not in plan


@pytest.mark.parametrize("size", [1, 5, 14])
def test_elimination_in_expressions(spark, size):
    rng = np.random.default_rng(size)
    a = rng.normal(size=(size, size))
    a = a @ a.T + np.eye(size)
    b = rng.normal(size=size)
    df = spark.createDataFrame([(np.column_stack((a, b)).tolist(),)], "m array<array<double>>")
    assert np.allclose(df.select(C.solve_spd(F.col("m"), size)).collect()[0][0], np.linalg.solve(a, b))
