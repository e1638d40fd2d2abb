"""Forecast against actuals: window filters, joins, split columns, RMSE, dashboard aggregates.

The actual side comes out of an ``explode``, whose rows no estimate counts, so its
joins are marked as merge joins: it is never broadcast on a wrong guess.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecast.functions import date_str, tumble_interval
from ratecast.operators.training import HOLDOUT_DAYS, max_minus



def _hi_lo(forecast: DataFrame, ts: str, days: int, hi: Column | None):
    """Last forecast time and ``last - days``; ``hi`` may be passed in when it is
    known without scanning the forecast (training end + horizon)."""
    if hi is None:
        return forecast.agg(F.max(ts)).scalar(), max_minus(forecast, ts, days)
    return hi, hi - F.expr(f"INTERVAL {int(days)} DAYS")


def forecast_window_filter(actual: DataFrame, forecast: DataFrame, ts: str = "ds",
                           days: int = HOLDOUT_DAYS, hi: Column | None = None) -> DataFrame:
    """Actual rows with ``max(ts) - days < tumble <= max(ts)`` of the forecast."""
    hi, lo = _hi_lo(forecast, ts, days, hi)
    return actual.filter((F.col("tumble") > lo) & (F.col("tumble") <= hi))


def forecast_vs_actual(forecast: DataFrame, actual: DataFrame, days: int = HOLDOUT_DAYS,
                       hi: Column | None = None) -> DataFrame:
    """Forecast LEFT JOIN the actuals of the holdout window on (symbol, time).

    Output ``symbol, ds, date_str, y, yhat, yhat_lower, yhat_upper, intrp``.
    """
    b = forecast_window_filter(actual, forecast, "ds", days, hi).select(
        F.col("symbol").alias("_bsym"), F.col("tumble").alias("_bts"), "intrp").hint("merge")
    j = forecast.join(b, (forecast.symbol == b._bsym) & (forecast.ds == b._bts), "left")
    return j.select("symbol", "ds", date_str("ds").alias("date_str"), "y", "yhat", "yhat_lower", "yhat_upper",
                    "intrp")


def forecast_vs_actual_split(forecast: DataFrame, actual: DataFrame, days: int = HOLDOUT_DAYS,
                             hi: Column | None = None) -> DataFrame:
    """Variant whose actual side is every hour up to ``max(ds)``; ``y`` and
    ``intrp`` are both taken from it, split at ``max(ds) - days`` (J5, P9)."""
    hi, cut = _hi_lo(forecast, "ds", days, hi)
    b = actual.filter(F.col("tumble") <= hi).select(
        F.col("symbol").alias("_bsym"), F.col("tumble").alias("_bts"), F.col("intrp").alias("_bv")).hint("merge")
    j = forecast.join(b, (forecast.symbol == b._bsym) & (forecast.ds == b._bts), "left")
    return j.select("symbol", "ds", date_str("ds").alias("date_str"), "yhat", "yhat_lower", "yhat_upper",
                    F.when(F.col("_bts") <= cut, F.col("_bv")).alias("y"),
                    F.when(F.col("_bts") > cut, F.col("_bv")).alias("intrp"))


def arima_vs_actual(explained: DataFrame, actual: DataFrame, days: int = HOLDOUT_DAYS,
                    hi: Column | None = None) -> DataFrame:
    """Explain-forecast relation LEFT JOIN actuals of the holdout window.

    ``y`` = data up to ``max - days``, ``yhat`` = data after it; the unsplit
    ``time_series_data`` is kept for the statistics. The relation is computed
    once and reused by every subquery of the plan.
    """
    ts = "time_series_timestamp"
    hi, cut = _hi_lo(explained, ts, days, hi)
    b = forecast_window_filter(actual, explained, ts, days, hi).select(
        F.col("symbol").alias("_bsym"), F.col("tumble").alias("_bts"), "intrp").hint("merge")
    j = explained.join(b, (explained.symbol == b._bsym) & (F.col(ts) == b._bts), "left")
    return j.select(
        "symbol", ts, date_str(ts).alias("date_str"),
        F.when(F.col(ts) <= cut, F.col("time_series_data")).alias("y"),
        F.when(F.col(ts) > cut, F.col("time_series_data")).alias("yhat"),
        F.col("prediction_interval_lower_bound").alias("yhat_lower"),
        F.col("prediction_interval_upper_bound").alias("yhat_upper"),
        "intrp", "time_series_data")


def _rmse(a: str, b: str):
    return F.sqrt(F.avg(F.pow(F.col(a) - F.col(b), 2)))


def forecast_rmse(scored: DataFrame, ts: str = "ds", by_symbol: bool = False,
                  days: int = HOLDOUT_DAYS, hi: Column | None = None) -> DataFrame:
    """``SQRT(AVG(POWER(intrp - yhat, 2)))`` and the same against both band edges,
    over rows after ``max(ts) - days`` (A8); overall or per symbol."""
    _, lo = _hi_lo(scored, ts, days, hi)
    rows = scored.filter(F.col(ts) > lo)
    aggs = [_rmse("intrp", "yhat").alias("rmse"), _rmse("intrp", "yhat_upper").alias("rmse_upper"),
            _rmse("intrp", "yhat_lower").alias("rmse_lower"), F.count("intrp").alias("n")]
    return rows.groupBy("symbol").agg(*aggs) if by_symbol else rows.agg(*aggs)


def dashboard_hourly(scored: DataFrame, ts: str = "ds") -> DataFrame:
    """Per "date hour": mean of y, yhat, both band edges and intrp."""
    return scored.groupBy(tumble_interval(ts, 3600).alias("date_hour")).agg(
        *[F.avg(c).alias(f"avg_{c}") for c in ("y", "yhat", "yhat_lower", "yhat_upper", "intrp")])
