"""Automatic AR order per series (``auto_arima``, max order 5), via ``applyInPandas``.

Order selection needs the whole ordered series of one symbol, which no
built-in aggregate expresses, so each symbol's rows go to one Python worker as
an Arrow batch. A series has one row per grid bucket (its time span over the
bucket width), so a group's size does not grow with the tick volume. Fitting is
numpy least squares; no third-party solver.

Model: ARIMA(p, d, 0) with intercept. ``d`` is the smallest order in 0..2 whose
differenced series has a lag-1 autoregression coefficient below 0.9 (a simple
unit-root screen); ``p`` in 0..5 minimises AIC ``n log(sigma2) + 2 (p + 1)``
on that series, all orders over the same last ``len - 5`` rows. Forecast intervals
come from the psi weights of ``phi(B) (1 - B)^d``. Missing and infinite values
are put on the line between their neighbours, so hours stay one step apart.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ratecast.operators.forecast import Z80
from ratecast.operators.training import HORIZON_HOURS

# Fixed values of the order search.
MAX_P = 5
MAX_D = 2
UNIT_ROOT_PHI = 0.9

EXPLAIN_SCHEMA = ("symbol string, time_series_timestamp timestamp_ntz, time_series_data double, "
                  "prediction_interval_lower_bound double, prediction_interval_upper_bound double")


def _fit_ar(z: np.ndarray, p: int, skip: int | None = None):
    """Least-squares AR(p) with intercept over all rows but the first ``skip`` (p); (coef [c, a1..ap], sigma2, n) or None."""
    skip = p if skip is None else skip
    n = len(z) - skip
    if n < p + 2:
        return None
    cols = [np.ones(n)] + [z[skip - i - 1:len(z) - i - 1] for i in range(p)]
    X = np.column_stack(cols)
    target = z[skip:]
    coef, *_ = np.linalg.lstsq(X, target, rcond=None)
    resid = target - X @ coef
    sigma2 = float(resid @ resid) / n
    return coef, sigma2, n


def _choose_d(y: np.ndarray) -> int:
    for d in range(MAX_D + 1):
        z = np.diff(y, n=d)
        f = _fit_ar(z, 1)
        if f is None:
            return d
        if abs(f[0][1]) < UNIT_ROOT_PHI:
            return d
    return MAX_D


def fit_forecast(y: np.ndarray, periods: int, z_score: float = Z80):
    """(point forecasts, interval half-widths, p, d) for one ordered series."""
    y = np.asarray(y, dtype=float)
    d = _choose_d(y)
    z = np.diff(y, n=d)
    best = None
    top = min(MAX_P, max(0, (len(z) - 2) // 2))
    for p in range(top + 1):
        f = _fit_ar(z, p, top)
        if f is None:
            continue
        coef, sigma2, n = f
        aic = n * np.log(max(sigma2, 1e-300)) + 2 * (p + 1)
        if best is None or aic < best[0]:
            best = (aic, p, coef, sigma2)
    if best is None:  # too short to fit anything: last value, no spread
        return np.full(periods, y[-1] if len(y) else np.nan), np.zeros(periods), 0, d
    _, p, coef, sigma2 = best
    c, a = coef[0], coef[1:]
    # recursive point forecast on the differenced scale
    hist = list(z[-p:]) if p else []
    zf = []
    for _ in range(periods):
        nxt = c + sum(a[i] * hist[-1 - i] for i in range(p))
        zf.append(nxt)
        hist.append(nxt)
    zf = np.array(zf)
    # integrate d times back to the level
    levels = zf
    for k in range(d, 0, -1):
        last = np.diff(y, n=k - 1)[-1]
        levels = last + np.cumsum(levels)
    # psi weights of phi(B)(1-B)^d
    poly = np.concatenate([[1.0], -a])
    for _ in range(d):
        poly = np.convolve(poly, [1.0, -1.0])
    ar = -poly[1:]
    psi = np.zeros(periods)
    psi[0] = 1.0
    for j in range(1, periods):
        m = min(j, len(ar))
        psi[j] = sum(ar[i] * psi[j - 1 - i] for i in range(m))
    half = z_score * np.sqrt(sigma2 * np.cumsum(psi ** 2))
    return levels, half, p, d


def complete(y: np.ndarray) -> np.ndarray:
    """The series with missing and infinite values on the line between their neighbours (at an end: the nearest)."""
    ok = np.isfinite(y)
    return np.interp(np.arange(len(y)), np.flatnonzero(ok), y[ok]) if ok.any() else y[:0]


def forecast_ar_auto(train: DataFrame, periods: int = HORIZON_HOURS, step_seconds: int = 3600) -> DataFrame:
    """Explain-forecast relation (T11) of the automatically ordered AR model per symbol (M5)."""

    def per_symbol(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds")
        y = pdf["y"].to_numpy(dtype=float)
        point, half, _, _ = fit_forecast(complete(y), periods)
        last = pdf["ds"].iloc[-1]
        fut_ts = last + pd.to_timedelta(np.arange(1, periods + 1) * step_seconds, unit="s")
        hist = pd.DataFrame({"symbol": pdf["symbol"].to_numpy(), "time_series_timestamp": pdf["ds"].to_numpy(),
                             "time_series_data": y, "prediction_interval_lower_bound": np.nan,
                             "prediction_interval_upper_bound": np.nan})
        fut = pd.DataFrame({"symbol": pdf["symbol"].iloc[0], "time_series_timestamp": fut_ts,
                            "time_series_data": point, "prediction_interval_lower_bound": point - half,
                            "prediction_interval_upper_bound": point + half})
        out = pd.concat([hist, fut], ignore_index=True)
        for c in ("prediction_interval_lower_bound", "prediction_interval_upper_bound"):
            out[c] = out[c].astype("float64")
        return out

    n = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # explicit count: AQE would pack small-looking groups into very few Python tasks
    rows = train.select("symbol", "ds", "y").repartition(n, "symbol")
    return rows.groupBy("symbol").applyInPandas(per_symbol, EXPLAIN_SCHEMA)
