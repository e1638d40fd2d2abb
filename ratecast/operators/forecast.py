"""Per-series forecasting, expressed as DataFrame aggregates and windows.

The third-party solvers of the reference (an additive/multiplicative trend +
seasonality fitter and the warehouse's ARIMA) are not available; these are
Spark-native models with the same inputs, outputs, horizon and interval level.
They do not reproduce those solvers' numbers.

Distribution: every statistic is a per-``symbol`` window aggregate, so after
one clustering on ``symbol`` the whole fit runs without another exchange; a
series is one grid row per bucket, so its size is bounded by the time span,
not by the tick count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratecast.functions import epoch_seconds
from ratecast.operators.training import HORIZON_HOURS

# Fixed value: two-sided 80 % normal interval.
Z80 = 1.2815515655446004


def cluster_series(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """Cluster rows on ``symbol`` over ``tasks`` (else ``spark.sql.shuffle.partitions``) partitions.

    A no-op when the frame is already so partitioned (Spark drops the shuffle);
    otherwise an explicit count keeps AQE from packing the window-heavy fit,
    whose cost is per row rather than per byte, into a few tasks.
    """
    n = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, "symbol")


def _with_future(train: DataFrame, periods: int, step_seconds: int, tasks: int | None = None) -> DataFrame:
    """Training rows plus ``periods`` future buckets per symbol with ``y`` NULL.

    The last row of each series (latest time; one row even if that time is
    duplicated) is exploded into itself plus the future buckets, so the training
    frame is read once and stays on its per-symbol sort.
    """
    base = cluster_series(train.select("symbol", "ds", "y"), tasks)
    if periods <= 0:
        return base
    # Ascending sort: the windows after this reuse it, so every per-series sum
    # accumulates in time order (deterministic, whatever order a shuffle gave).
    w = Window.partitionBy("symbol").orderBy(F.col("ds").asc(), F.col("y").asc_nulls_first())
    marked = base.withColumn("_last", F.lead(F.lit(1)).over(w).isNull())
    steps = F.when(F.col("_last"), F.sequence(F.lit(0), F.lit(int(periods)))).otherwise(F.array(F.lit(0)))
    f = marked.select("symbol", "ds", "y", F.explode(steps).alias("_h"))
    return f.select(
        "symbol",
        F.timestamp_add("SECOND", F.col("_h").cast("long") * int(step_seconds), F.col("ds")).alias("ds"),
        F.when(F.col("_h") == 0, F.col("y")).alias("y"))


def _series_window(*keys) -> Window:
    """Whole frame of the rows sharing ``keys``, in time order.

    Sums accumulate in a fixed order, so the fit does not change with how a
    shuffle delivered the rows. The frame is clustered on ``symbol``, which
    also clusters (symbol, hour) and (symbol, weekday): those windows only
    re-sort inside each partition (measured cheaper than spelling the 24 hour
    means as conditional aggregates over one window).
    """
    return Window.partitionBy(*keys).orderBy("ds").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def seasonal_components(train: DataFrame, periods: int = HORIZON_HOURS, step_seconds: int = 3600,
                        tasks: int | None = None) -> DataFrame:
    """Trend, hour-of-day and weekday indices of each series (M1, M6).

    * ``T`` = hours since 1970; ``trend = avg(y) + m (T - avg(T))`` with
      ``m = regr_slope(y, T)`` (the regression line in centred form);
    * ``i_h`` = mean of ``y / trend`` over the series' rows at that hour of day
      (ratio 1 where ``trend <= 0``), ``i_d`` the same on ``y / (trend i_h)``
      over the day of week; an hour or weekday never seen in training gets 1;
    * ``fitted = trend i_h i_d`` (multiplicative), ``sd`` = sample standard
      deviation of ``y - fitted`` over training rows.

    Rows with NULL ``y`` (the future, or a NULL value) are skipped by every
    aggregate, so the same windows fit the history and score the horizon.
    After one clustering on ``symbol`` there is no further exchange.
    """
    f = _with_future(train, periods, step_seconds, tasks)
    sym = _series_window("symbol")
    y = F.col("y")
    f = f.withColumn("t", epoch_seconds("ds") / F.lit(3600.0))
    f = f.withColumn("trend", F.avg(y).over(sym)
                     + F.regr_slope(y, F.col("t")).over(sym)
                     * (F.col("t") - F.avg(F.when(y.isNotNull(), F.col("t"))).over(sym)))
    r1 = F.when(y.isNull(), F.lit(None).cast("double")).when(F.col("trend") > 0, y / F.col("trend")) \
        .otherwise(F.lit(1.0))
    f = f.withColumn("i_h", F.coalesce(F.avg(r1).over(_series_window("symbol", F.hour("ds"))), F.lit(1.0)))
    base = F.col("trend") * F.col("i_h")
    r2 = F.when(y.isNull(), F.lit(None).cast("double")).when(base > 0, y / base).otherwise(F.lit(1.0))
    f = f.withColumn("i_d", F.coalesce(F.avg(r2).over(_series_window("symbol", F.dayofweek("ds"))), F.lit(1.0)))
    f = f.withColumn("fitted", F.col("trend") * F.col("i_h") * F.col("i_d"))
    return f.withColumn("sd", F.stddev_samp(y - F.col("fitted")).over(sym))


def forecast_seasonal(train: DataFrame, periods: int = HORIZON_HOURS, step_seconds: int = 3600,
                      z: float = Z80, tasks: int | None = None) -> DataFrame:
    """Trend x seasonality forecast with an 80 % band.

    Output ``symbol, ds, y, yhat, yhat_lower, yhat_upper``: every training time
    (``y`` = training value) plus ``periods`` future buckets (``y`` NULL).
    """
    f = seasonal_components(train, periods, step_seconds, tasks)
    band = F.lit(float(z)) * F.col("sd")
    return f.select("symbol", "ds", "y", F.col("fitted").alias("yhat"),
                    (F.col("fitted") - band).alias("yhat_lower"), (F.col("fitted") + band).alias("yhat_upper"))


def decompose(train: DataFrame, tasks: int | None = None) -> DataFrame:
    """Training rows split into trend, seasonal factor and remainder (M6)."""
    f = seasonal_components(train, periods=0, tasks=tasks).filter(F.col("y").isNotNull())
    return f.select("symbol", "ds", "y", "trend", (F.col("i_h") * F.col("i_d")).alias("seasonal"),
                    (F.col("y") - F.col("fitted")).alias("remainder"))


def _ar1_frame(train: DataFrame, tasks: int | None = None) -> DataFrame:
    """Training rows with ``x = lag(y)``, a last-row flag and the AR(1) fit of the series.

    ``phi, c = regr_slope/regr_intercept(y, x)``; residual variance
    ``sigma2 = SSE / (n - 2)`` with ``SSE = Syy - Sxy^2 / Sxx``. A series whose
    fit is not stationary (``|phi| >= 1``, no fit, or ``n < 3``) is a random
    walk: ``phi = 1`` and ``sigma2 = mean((y - x)^2)``. All statistics are
    time-ordered whole-series windows over one clustering on ``symbol``.
    """
    w = Window.partitionBy("symbol").orderBy(F.col("ds").asc(), F.col("y").asc_nulls_first())
    f = cluster_series(train.select("symbol", "ds", "y"), tasks)
    f = f.withColumn("x", F.lag("y").over(w)).withColumn("_last", F.lead(F.lit(1)).over(w).isNull())
    full = _series_window("symbol")
    y, x = F.col("y"), F.col("x")
    f = f.select("*",
                 F.regr_slope(y, x).over(full).alias("phi_raw"), F.regr_intercept(y, x).over(full).alias("c_raw"),
                 F.regr_count(y, x).over(full).alias("n"), F.regr_sxx(y, x).over(full).alias("sxx"),
                 F.regr_syy(y, x).over(full).alias("syy"), F.regr_sxy(y, x).over(full).alias("sxy"),
                 F.avg(F.pow(y - x, 2)).over(full).alias("rw_var"))
    stationary = F.col("phi_raw").isNotNull() & (F.abs(F.col("phi_raw")) < 1) & (F.col("n") >= 3)
    sse = F.col("syy") - F.col("sxy") * F.col("sxy") / F.col("sxx")
    return f.select(
        "symbol", "ds", "y", "_last", "n",
        F.when(stationary, F.col("phi_raw")).otherwise(F.lit(1.0)).alias("phi"),
        F.when(stationary, F.col("c_raw")).otherwise(F.lit(0.0)).alias("c"),
        F.when(stationary, F.col("c_raw") / (F.lit(1.0) - F.col("phi_raw"))).alias("mu"),
        F.when(stationary, sse / (F.col("n") - 2)).otherwise(F.col("rw_var")).alias("sigma2"),
        stationary.alias("stationary"),
    )


def ar1_params(train: DataFrame, tasks: int | None = None) -> DataFrame:
    """AR(1) fit per symbol (M4, the model table T10): the last row of each series."""
    f = _ar1_frame(train, tasks).filter(F.col("_last"))
    return f.select("symbol", "n", F.col("y").alias("y_last"), F.col("ds").alias("ds_last"),
                    "phi", "c", "mu", "sigma2", "stationary")


def _ar1_point_band(h: Column, y_last: Column, z: float):
    phi, mu, s2 = F.col("phi"), F.col("mu"), F.col("sigma2")
    point = F.when(F.col("stationary"), mu + F.pow(phi, h) * (y_last - mu)).otherwise(y_last)
    var = F.when(F.col("stationary"), s2 * (F.lit(1.0) - F.pow(phi, 2 * h)) / (F.lit(1.0) - phi * phi)) \
        .otherwise(s2 * h)
    return point, F.lit(float(z)) * F.sqrt(var)


def explain_forecast(params: DataFrame, train: DataFrame, periods: int = HORIZON_HOURS,
                     step_seconds: int = 3600, z: float = Z80, tasks: int | None = None) -> DataFrame:
    """History and forecast in one relation from a stored model table.

    History rows carry the training value and no band; forecast rows carry
    ``mu + phi^h (y_T - mu)`` (``y_T`` for a random walk) with band
    ``z sqrt(sigma2 (1 - phi^2h) / (1 - phi^2))`` (``z sqrt(sigma2 h)`` for a
    random walk).
    """
    h = F.col("_h").cast("double")
    point, half = _ar1_point_band(h, F.col("y_last"), z)
    params = params.repartition(tasks, "symbol") if tasks else params  # dealt as the history is, so the union stays clustered
    fut = params.select("*", F.explode(F.sequence(F.lit(1), F.lit(int(periods)))).alias("_h")).select(
        "symbol",
        F.timestamp_add("SECOND", F.col("_h").cast("long") * int(step_seconds), F.col("ds_last"))
        .alias("time_series_timestamp"),
        point.alias("time_series_data"),
        (point - half).alias("prediction_interval_lower_bound"),
        (point + half).alias("prediction_interval_upper_bound"))
    hist = train.select("symbol", F.col("ds").alias("time_series_timestamp"), F.col("y").alias("time_series_data"),
                        F.lit(None).cast("double").alias("prediction_interval_lower_bound"),
                        F.lit(None).cast("double").alias("prediction_interval_upper_bound"))
    return hist.unionByName(fut)


def forecast_ar1(train: DataFrame, periods: int = HORIZON_HOURS, step_seconds: int = 3600,
                 z: float = Z80, tasks: int | None = None) -> DataFrame:
    """AR(1) explain-forecast relation for every series (M4), in one pass.

    The last row of each series is exploded into itself plus the ``periods``
    forecast rows, so the training frame is read once and never joined with
    its own parameters.
    """
    f = _ar1_frame(train, tasks)
    steps = F.when(F.col("_last"), F.sequence(F.lit(0), F.lit(int(periods)))).otherwise(F.array(F.lit(0)))
    e = f.select("*", F.explode(steps).alias("_h"))
    h = F.col("_h").cast("double")
    point, half = _ar1_point_band(h, F.col("y"), z)
    fut = F.col("_h") > 0
    return e.select(
        "symbol",
        F.timestamp_add("SECOND", F.col("_h").cast("long") * int(step_seconds), F.col("ds")).alias("time_series_timestamp"),
        F.when(fut, point).otherwise(F.col("y")).alias("time_series_data"),
        F.when(fut, point - half).alias("prediction_interval_lower_bound"),
        F.when(fut, point + half).alias("prediction_interval_upper_bound"))
