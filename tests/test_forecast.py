"""Properties of the forecast operators on the fixture tables and on hand-made series."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecast.operators import evaluate as E
from ratecast.operators import forecast as M
from ratecast.operators import training as TR
from ratecast.operators.ar_auto import fit_forecast, forecast_ar_auto
from ratecast.operators.gridding import hourly_mean, interpolate_hourly
from ratecast.sources.fixtures import read_ticks

SF = "/root/testdata/sf0.001"
TRAIN = "symbol string, ds timestamp_ntz, y double"


@pytest.fixture(scope="module")
def t5(spark):
    return interpolate_hourly(hourly_mean(read_ticks(spark, SF, "event_type"))).cache()


@pytest.fixture(scope="module")
def train(t5):
    return TR.series_min_length(TR.to_training_frame(TR.holdout_cut(t5))).cache()


def _series(spark, name, ys, start=dt.datetime(2024, 1, 1)):
    return spark.createDataFrame([(name, start + dt.timedelta(hours=i), float(y)) for i, y in enumerate(ys)], TRAIN)


def test_holdout_cut_is_five_days(t5, train):
    mx = t5.agg(F.max("tumble")).first()[0]
    assert train.agg(F.max("ds")).first()[0] == mx - dt.timedelta(days=5)


def test_seasonal_horizon_and_band(train):
    fc = M.forecast_seasonal(train)
    per = fc.filter(F.col("y").isNull()).groupBy("symbol").count().collect()
    assert all(r["count"] == 120 for r in per)
    assert fc.filter(~((F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper")))).count() == 0
    assert fc.count() == train.count() + 120 * len(per)


def test_horizon_with_different_last_hours(spark):
    df = _series(spark, "a", range(10)).unionByName(_series(spark, "b", range(20)))
    h = TR.forecast_horizon(df).filter("is_future")
    got = {r["symbol"]: (r["n"], r["first"]) for r in
           h.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.min("ds").alias("first")).collect()}
    assert got["a"] == (120, dt.datetime(2024, 1, 1, 10)) and got["b"] == (120, dt.datetime(2024, 1, 1, 20))


def test_linear_series_fits_exactly(spark):
    tr = _series(spark, "lin", [10 + 0.5 * i for i in range(24 * 14)])
    fc = M.forecast_seasonal(tr)
    err = fc.filter(F.col("y").isNotNull()).agg(F.max(F.abs(F.col("y") - F.col("yhat")))).first()[0]
    assert err < 1e-6
    fut = fc.filter(F.col("y").isNull()).orderBy("ds").first()
    assert abs(fut["yhat"] - (10 + 0.5 * 24 * 14)) < 1e-6


def test_perfect_forecast_has_zero_rmse(spark):
    rows = spark.createDataFrame([("s", dt.datetime(2024, 1, 1, h), 1.0, 1.0, 0.5, 1.5, 1.0) for h in range(12)],
                                 "symbol string, ds timestamp_ntz, y double, yhat double, yhat_lower double, "
                                 "yhat_upper double, intrp double")
    r = E.forecast_rmse(rows).first()
    assert r["rmse"] == 0.0 and r["rmse_upper"] == 0.5 and r["rmse_lower"] == 0.5


def test_ar1_recovers_phi(spark):
    rng = np.random.default_rng(7)
    y = [0.0]
    for _ in range(3000):
        y.append(5 + 0.6 * (y[-1] - 5) + rng.normal())
    p = M.ar1_params(_series(spark, "ar", y)).first()
    assert abs(p["phi"] - 0.6) < 0.05 and abs(p["mu"] - 5) < 0.2 and p["stationary"]
    assert abs(p["sigma2"] - 1.0) < 0.1


def test_ar1_random_walk_fallback(spark):
    p = M.ar1_params(_series(spark, "rw", [float(i) for i in range(50)])).first()
    assert p["phi"] == 1.0 and not p["stationary"]
    xf = M.forecast_ar1(_series(spark, "rw", [float(i) for i in range(50)]))
    fut = xf.filter(F.col("prediction_interval_lower_bound").isNotNull()).orderBy("time_series_timestamp").collect()
    assert len(fut) == 120 and fut[0]["time_series_data"] == 49.0


def test_ar_auto_properties(spark, train):
    xf = forecast_ar_auto(train)
    fut = xf.filter(F.col("prediction_interval_lower_bound").isNotNull())
    assert all(r["count"] == 120 for r in fut.groupBy("symbol").count().collect())
    bad = fut.filter(~((F.col("prediction_interval_lower_bound") <= F.col("time_series_data"))
                       & (F.col("time_series_data") <= F.col("prediction_interval_upper_bound"))))
    assert bad.count() == 0


def test_ar_auto_numpy_core():
    rng = np.random.default_rng(3)
    y = np.cumsum(rng.normal(size=400)) + 100      # random walk -> one difference
    point, half, p, d = fit_forecast(y, 24)
    assert d == 1 and len(point) == 24 and np.all(np.diff(half) >= -1e-12)
    x = [0.0]
    for _ in range(2000):
        x.append(0.7 * x[-1] + rng.normal())
    point, half, p, d = fit_forecast(np.array(x), 10)
    assert d == 0 and p >= 1 and math.isfinite(point[-1])


def test_infer_frequency(spark):
    df = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 1, h)) for h in (0, 1, 2, 3, 5)] + [("b", dt.datetime(2024, 1, 1, h)) for h in (0, 2, 4)],
        "symbol string, tumble timestamp_ntz")
    got = {r["symbol"]: r["freq_seconds"] for r in TR.infer_frequency(df).collect()}
    assert got == {"a": 3600, "b": 7200}


def test_decompose_reconstructs(train):
    d = M.decompose(train)
    assert d.count() == train.count()
    assert d.filter(F.abs(F.col("trend") * F.col("seasonal") + F.col("remainder") - F.col("y")) > 1e-9).count() == 0


def test_small_rates_keep_their_digits(spark):
    """A series around 3e-7 (a token rate) comes out at its size, not as zero."""
    tr = _series(spark, "s", [3e-7 * (1 + 0.001 * (i % 7)) for i in range(24 * 14)])
    for out, value in ((M.forecast_seasonal(tr), "yhat"), (M.forecast_ar1(tr), "time_series_data")):
        lo, hi = out.agg(F.min(value), F.max(value)).first()
        assert 2.9e-7 < lo <= hi < 3.1e-7
    scored = spark.createDataFrame([("s", dt.datetime(2024, 1, 1, h), 3.1e-7, 3e-7, 2e-7, 4e-7) for h in range(5)],
                                   "symbol string, ds timestamp_ntz, intrp double, yhat double, yhat_lower double, yhat_upper double")
    assert abs(E.forecast_rmse(scored).first()["rmse"] - 1e-8) < 1e-16


def test_exploded_sides_are_never_broadcast(spark):
    """2000 sparse series: a few KB of ticks, but 17 million grid rows that no estimate counts."""
    a, b = dt.datetime(2023, 1, 1), dt.datetime(2024, 1, 1)
    ticks = spark.range(2000).select(F.explode(F.array(F.lit(a).cast("timestamp_ntz"), F.lit(b).cast("timestamp_ntz"))).alias("timestamp"),
                                     F.col("id").cast("string").alias("symbol"), F.lit(1.0).alias("rate"))
    t5 = interpolate_hourly(hourly_mean(ticks))
    fc = M.forecast_seasonal(TR.to_training_frame(TR.holdout_cut(t5)))
    xf = M.forecast_ar1(TR.to_training_frame(TR.holdout_cut(t5)))
    for df in (E.forecast_vs_actual(fc, t5), E.forecast_vs_actual_split(fc, t5), E.arima_vs_actual(xf, t5)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
