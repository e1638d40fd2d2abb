"""Automatic ARIMA: differencing, both Hannan-Rissanen stages, refinement, planted orders, forecasts."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecast.operators import arima as A

TRAIN = "symbol string, ds timestamp_ntz, y double"
START = dt.datetime(2024, 1, 1)


def simulate(rng, n, phi=(), theta=(), d=0):
    e = rng.normal(size=n + 200)
    w = np.zeros(n + 200)
    for t in range(5, n + 200):
        w[t] = sum(c * w[t - 1 - i] for i, c in enumerate(phi)) + e[t] + sum(c * e[t - 1 - j] for j, c in enumerate(theta))
    w = w[200:]
    for _ in range(d):
        w = np.cumsum(w)
    return w


def frame(spark, series):
    rows = [(name, START + dt.timedelta(hours=i), None if y is None else float(y)) for name, ys in series.items() for i, y in enumerate(ys)]
    return spark.createDataFrame(rows, TRAIN).repartition(4)


def brute_kpss(w):
    n = len(w)
    x = w - w.mean()
    g = [(w[k:] * w[:n - k]).sum() / n - w.mean() ** 2 for k in range(A.KPSS_LAGS + 2)]
    top = 1 - 2 / np.sqrt(n)
    rho = np.clip(g[1] / g[0], -top, top)
    white = [(1 + rho ** 2) * g[k] - rho * (g[k + 1] + g[abs(k - 1)]) for k in range(A.KPSS_LAGS + 1)]
    width = min(int(4 * (n / 100) ** 0.25), A.KPSS_LAGS)
    long_run = max(white[0] + 2 * sum(max(1 - k / (width + 1), 0) * white[k] for k in range(1, A.KPSS_LAGS + 1)), 1e-3 * white[0]) / (1 - rho) ** 2
    return (np.cumsum(x) ** 2).sum() / (n * n * long_run)


#: order, coefficients
PLANTED = {(1, 0, 0): ((0.7,), ()), (0, 0, 1): ((), (0.6,)), (2, 0, 0): ((0.5, -0.4), ()), (1, 0, 1): ((0.6,), (0.5,)), (0, 1, 1): ((), (-0.6,)),
           (1, 1, 0): ((0.7,), ()), (0, 1, 0): ((), ()), (1, 2, 1): ((0.5,), (0.5,))}


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(11)
    return {f"{o}-{i}": simulate(rng, 1200, *c, o[1]) for o, c in PLANTED.items() for i in range(8)}


def test_planted_orders_are_recovered(spark, planted):
    got = {r.symbol: (r.p, r.d, r.q) for r in A.arima_model(frame(spark, planted)).collect()}
    right = [str(o) == k.split("-")[0] for k, o in got.items()]
    assert len(got) == len(planted) and np.mean(right) >= 0.9, {k: v for k, v in got.items() if str(v) != k.split("-")[0]}


def test_coefficients_are_near_the_truth(spark):
    rng = np.random.default_rng(12)
    series = {f"a{i}": simulate(rng, 1500, (0.6,), (0.5,)) for i in range(6)}
    rows = A.arima_model(frame(spark, series)).where("p = 1 AND q = 1 AND d = 0").collect()
    assert len(rows) >= 5
    assert abs(np.mean([r.phi[0] for r in rows]) - 0.6) < 0.05 and abs(np.mean([r.theta[0] for r in rows]) - 0.5) < 0.05
    assert abs(np.mean([r.sigma2 for r in rows]) - 1) < 0.06


def test_kpss_against_brute_force(spark, planted):
    some = {k: v for k, v in planted.items() if k.endswith("-0")}
    got = {(r.symbol, r.d): r.kpss for r in A.kpss_statistics(frame(spark, some)).collect()}
    for k, y in some.items():
        for d in range(3):
            want = brute_kpss(np.diff(y - y.mean(), n=d))
            assert abs(got[k, d] - want) < 1e-6 * max(1, want), (k, d)


def test_strongly_correlated_but_stationary_series_is_not_differenced(spark):
    rng = np.random.default_rng(13)
    series = {f"s{i}": simulate(rng, 800, (0.92,)) for i in range(20)}
    d = [r.d for r in A.differencing(frame(spark, series)).collect()]
    assert d.count(0) >= 18


def test_hannan_rissanen_against_design_matrices(spark):
    rng = np.random.default_rng(14)
    y = simulate(rng, 500, (0.6, -0.2), (0.4,))
    w = y - y.mean()
    e = A.long_residuals(w)
    s = A.LONG + 2  # both lags of the innovations are known from here on
    x = np.column_stack([np.ones(len(w) - s), w[s - 1:-1], w[s - 2:-2], e[s - 1:-1]])
    want = np.linalg.lstsq(x, w[s:], rcond=None)[0]
    r = A.hannan_rissanen(A.difference(frame(spark, {"a": y})), 2, 1).collect()[0]
    assert np.allclose([r.const, *r.phi, *r.theta], want, atol=1e-6)
    assert abs(r.sigma2 - ((w[s:] - x @ want) ** 2).mean()) < 1e-6 and r.n == len(w) - s


def test_all_orders_come_from_one_gram_matrix(spark):
    rng = np.random.default_rng(15)
    y = simulate(rng, 600, (0.7,))
    g = A.arma_gram(A.innovations(A.difference(frame(spark, {"a": y})))).collect()[0]
    ranked = A.rank_orders(np.array([g.gram]), np.array([g.yy]), np.array([float(g.n)]))[0]
    assert len(ranked) == A.CANDIDATES and ranked[0] == (1, 0)


def brute_css(w, p, q, beta):
    e = np.zeros(len(w))
    for t in range(p, len(w)):
        e[t] = w[t] - beta[0] - sum(beta[1 + i] * w[t - 1 - i] for i in range(p)) - sum(beta[1 + p + j] * e[t - 1 - j] for j in range(q) if t - 1 - j >= 0)
    return float((e[A.MAX_ORDER:] ** 2).sum())


def test_refinement_reaches_a_minimum_of_the_conditional_sum_of_squares():
    rng = np.random.default_rng(16)
    w = simulate(rng, 400, (0.5,), (0.6, 0.3))
    beta, sse, n = A.css(w, 1, 2)
    assert n == 395 and abs(sse - brute_css(w, 1, 2, beta)) < 1e-6 * sse
    for i in range(4):
        for h in (-1e-3, 1e-3):
            moved = beta.copy()
            moved[i] += h
            assert brute_css(w, 1, 2, moved) >= sse - 1e-4


def test_forecast_of_known_models():
    """Point forecasts and psi weights against the recursion written out."""
    y = np.array([3.0, 4.0, 6.0, 5.0, 7.0, 8.0, 7.5, 9.0, 9.5, 11.0])
    assert np.allclose(A.forecast_levels(y, 1, 0, 0, np.array([0.5]), 3), [11.5, 12.0, 12.5])
    w = np.diff(y)
    e = np.zeros(len(w))
    for t in range(1, len(w)):
        e[t] = w[t] - 0.2 - 0.3 * w[t - 1] - 0.4 * e[t - 1]
    one = 0.2 + 0.3 * w[-1] + 0.4 * e[-1]
    two = 0.2 + 0.3 * one
    assert np.allclose(A.forecast_levels(y, 1, 1, 1, np.array([0.2, 0.3, 0.4]), 2), [11 + one, 11 + one + two])
    assert np.allclose(A.psi_weights(np.array([0.5]), np.array([0.4]), 0, 4), [1, 0.9, 0.45, 0.225])
    assert np.allclose(A.psi_weights(np.array([]), np.array([]), 1, 4), [1, 1, 1, 1])


def test_band_holds_its_share_of_the_future(spark):
    rng = np.random.default_rng(17)
    series = {f"s{i}": simulate(rng, 500, (0.6,), (0.5,)) for i in range(60)}
    fc = A.forecast_arima(frame(spark, {k: v[:480] for k, v in series.items()}), periods=20)
    rows = fc.where("prediction_interval_lower_bound IS NOT NULL").collect()
    inside = [r.prediction_interval_lower_bound <= series[r.symbol][480 + int((r.time_series_timestamp - START).total_seconds() / 3600) - 480] <= r.prediction_interval_upper_bound for r in rows]
    assert len(rows) == 1200 and 0.74 <= np.mean(inside) <= 0.86


def test_edge_cases(spark):
    nan = float("nan")
    series = {"short": [1.0, 2.0, 4.0], "flat": [5.0] * 100, "gaps": [1.0, None, nan, 2.0] * 30, "none": [None, None], "line": list(range(200)), "one": [3.0]}
    fc = A.forecast_arima(frame(spark, series), periods=4)
    by = {}
    for r in fc.orderBy("symbol", "time_series_timestamp").collect():
        by.setdefault(r.symbol, []).append(r)
    assert {k: len(v) for k, v in by.items()} == {k: len(v) + 4 for k, v in series.items()}
    assert all(abs(r.time_series_data - 5) < 1e-9 for r in by["flat"])
    assert np.allclose([r.time_series_data for r in by["line"][-4:]], [200, 201, 202, 203], atol=1e-3)
    assert all(np.isfinite(r.time_series_data) for k in ("short", "one", "gaps") for r in by[k][-4:])
    assert A.forecast_arima(spark.createDataFrame([], TRAIN), periods=4).count() == 0
    assert A.kpss_statistics(frame(spark, {"flat": [5.0] * 50})).agg(F.max("kpss")).collect()[0][0] == 0.0


def test_weights_and_roots_are_as_by_the_recursion_and_the_roots():
    rng = np.random.default_rng(0)
    for _ in range(2000):
        c = rng.normal(0, 0.7, rng.integers(0, 6))
        roots = np.roots(np.concatenate((c[::-1], [1.0]))) if c.size else np.empty(0)
        outside = bool((np.abs(roots) > 1.001).all())
        assert A._rooted_outside(c) == outside
        if outside:
            h, want = A._inverse(c, 300), [1.0]
            for k in range(1, 300):
                want.append(-sum(x * want[k - 1 - j] for j, x in enumerate(c[:k])))
            assert np.allclose(np.concatenate((h, np.zeros(300 - len(h)))), want, atol=1e-8)


def test_weights_are_not_one_python_step_each():
    import time

    def best(f):
        return min((lambda t: (f(), time.perf_counter() - t)[1])(time.perf_counter()) for _ in range(7))

    steps = best(lambda: [x * 0.5 + 0.1 for x in range(20000)])
    assert best(lambda: A._inverse(np.array([0.999, 0.0, 0.0]), 20000)) < 6 * steps


def test_candidates_come_back_from_their_number():
    for some in ([], [(0, 0)], [(5, 0), (0, 5), (2, 1)]):
        code = 0
        for p, q in some:
            code = code * A.CODE + p * (A.MAX_ORDER + 1) + q + 1
        assert [(c["p"], c["q"]) for c in A._decoded(float(code))] == some
    assert A._decoded(float("nan")) == []
