"""Queries without an SQL oracle, and a hot-key case, against brute force on small fixtures."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ratecast.operators.ar_auto import fit_forecast
from ratecast.operators.gridding import hourly_mean, interpolate_hourly
from ratecast.plans.model_queries import _Stage
from ratecast.sources.fixtures import ticks_from_events
from ratecast.operators.ar_auto import forecast_ar_auto

SF = "/root/testdata/sf0.001"


def _ar_by_normal_equations(y, periods):
    """The model written again: orders by AIC over one sample, normal equations, recursion."""
    d = 0
    while d < 2:
        z = np.diff(y, n=d)
        x, t = z[:-1] - z[:-1].mean(), z[1:] - z[1:].mean()
        if abs((x * t).sum() / (x * x).sum()) < 0.9:
            break
        d += 1
    z = np.diff(y, n=d)
    rows = range(5, len(z))
    best = None
    for p in range(6):
        a = np.array([[1.0] + [z[t - k] for k in range(1, p + 1)] for t in rows])
        b = np.array([z[t] for t in rows])
        w = np.linalg.solve(a.T @ a, a.T @ b)
        aic = len(b) * np.log(((b - a @ w) ** 2).mean()) + 2 * (p + 1)
        if best is None or aic < best[0]:
            best = (aic, p, w)
    _, p, w = best
    series = list(z)
    for _ in range(periods):
        series.append(w[0] + sum(w[k] * series[-k] for k in range(1, p + 1)))
    out = np.array(series[len(z):])
    for k in range(d, 0, -1):
        out = np.diff(y, n=k - 1)[-1] + np.cumsum(out)
    return out


def test_ar_auto_matches_driver_loop(spark):
    train = _Stage(spark, SF).train_ar
    got = forecast_ar_auto(train).filter(F.col("prediction_interval_lower_bound").isNotNull()).toPandas()
    pdf = train.toPandas().sort_values(["symbol", "ds"])
    for sym, g in pdf.groupby("symbol"):
        y = g["y"].to_numpy(dtype=float)
        point, half, _, _ = fit_forecast(y, 120)
        np.testing.assert_allclose(point, _ar_by_normal_equations(y, 120), rtol=1e-6, atol=1e-6)
        mine = got[got.symbol == sym].sort_values("time_series_timestamp")
        assert len(mine) == 120
        assert mine["time_series_timestamp"].iloc[0] == g["ds"].max() + pd.Timedelta(hours=1)
        np.testing.assert_allclose(mine["time_series_data"].to_numpy(), point, rtol=1e-12, atol=1e-12)
        np.testing.assert_allclose(mine["prediction_interval_upper_bound"].to_numpy(), point + half, rtol=1e-12)


def _pandas_gap_fill(ticks: pd.DataFrame) -> pd.DataFrame:
    """Brute-force reference: hourly means, full grid, linear fill, 0.0 at open ends."""
    t = ticks.copy()
    t["tumble"] = t["timestamp"].dt.floor("h")
    h = t.groupby(["symbol", "tumble"]).agg(mean=("rate", "mean"), count=("rate", "size")).reset_index()
    hours = pd.date_range(h.tumble.min(), h.tumble.max(), freq="h")
    out = []
    for sym, g in h.groupby("symbol"):
        s = g.set_index("tumble")["mean"].reindex(hours)
        known = s.dropna()
        x = known.index.asi8 // 10**9
        vals = s.to_numpy().copy()
        pos = hours.asi8 // 10**9
        for i in range(len(vals)):
            if not np.isnan(vals[i]):
                continue
            left, right = x[x < pos[i]], x[x > pos[i]]
            if len(left) == 0 or len(right) == 0:
                vals[i] = 0.0
            else:
                px, nx = left[-1], right[0]
                py, ny = known.iloc[len(left) - 1], known.iloc[len(left)]
                vals[i] = (ny - py) / (nx - px) * (pos[i] - px) + py
        out.append(pd.DataFrame({"symbol": sym, "tumble": hours, "intrp": vals}))
    return pd.concat(out, ignore_index=True)


def test_hot_symbol_gap_fill_matches_brute_force(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    # one symbol holds a third of all ticks
    skewed = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))
    ticks = ticks_from_events(skewed, "user_id")
    got = interpolate_hourly(hourly_mean(ticks)).select("symbol", "tumble", "intrp").toPandas()
    want = _pandas_gap_fill(ticks.select("symbol", "timestamp", "rate").toPandas())
    m = got.merge(want, on=["symbol", "tumble"], how="outer", suffixes=("_s", "_p"), indicator=True)
    assert (m["_merge"] == "both").all()
    np.testing.assert_allclose(m["intrp_s"].to_numpy(), m["intrp_p"].to_numpy(), rtol=1e-9, atol=1e-9)
    assert (ticks.filter(F.col("symbol") == "-1").count() * 3) >= ticks.count() - 3


def test_ar_auto_gaps_and_infinite_values():
    from ratecast.operators.ar_auto import complete

    y = np.array([1.0, np.nan, 3.0, np.inf, np.nan, 6.0, np.nan])
    np.testing.assert_allclose(complete(y), [1, 2, 3, 4, 5, 6, 6])
    point, half, _, _ = fit_forecast(complete(np.r_[y, np.full(40, np.nan)]), 5)
    assert np.isfinite(point).all() and np.isfinite(half).all()


def test_hourly_means_over_many_files(spark):
    """The sum's order follows the partitions, so means agree to a tolerance, not to the last bit."""
    ticks = ticks_from_events(spark.read.parquet(f"{SF}/events.parquet"))
    a, b = (hourly_mean(t).toPandas().sort_values(["symbol", "tumble"]) for t in (ticks, ticks.repartition(7)))
    np.testing.assert_allclose(a["mean"].to_numpy(), b["mean"].to_numpy(), rtol=1e-12)
