"""Piecewise-linear trend with sparse changepoints, times a smooth seasonality (M1).

The model of a series is ``y = ymax * g(t) * (1 + x(time) . beta)``:

* ``t`` is the time scaled to 0..1 over the training rows, ``g(t) = m + k t + sum_j delta_j max(t - s_j, 0)``
  with CHANGEPOINTS candidates ``s_j`` evenly over the first RANGE of the history; an L1
  penalty on ``delta`` leaves only the breaks that the data ask for;
* ``x`` are sines and cosines of the time of day (if the history spans two days) and of the week (two weeks).

It is fitted by turns, trend and seasonality given the other, ROUNDS times. Rows
are never gathered by series: the trend's Gram matrix follows from five sums per
(series, cell between candidates), that of the seasonality from two sums per (series, time
of week), all combined before their shuffle. So a series of any length
spreads over all tasks, and what is solved is a few hundred numbers a series:
the penalised trend by coordinate descent in one vectorised pass over a batch of
series, the seasonality by elimination in column expressions.

Penalties are those of a maximum a posteriori fit: ``sigma2 / FLEXIBILITY`` on
``|delta|`` (Laplace prior), ``sigma2 / SEASONAL_SCALE ** 2`` on ``beta ** 2`` (normal
prior), ``sigma2`` being the residual variance so far.

The band of the history is the residual spread. In the future the trend may break
as often and as strongly as it did: seeded simulation of such breaks and of noise, whose draws are hashes of
(seed, series, sample, step), gives the quantiles of every step. So the band widens
with the horizon, and is the same whatever the partitions.

Defined cases: rows with a null, NaN or infinite ``y`` are not fitted, but scored; a series without any other is
left out; one time only gives a constant; an all-zero series is fitted as zero.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecast.functions import epoch_seconds
from ratecast.operators.forecast import Z80
from ratecast.operators.training import HORIZON_HOURS
from ratecast.sources.sinks import materialize

# Candidates, the part of the history that holds them, prior scales, Fourier orders.
CHANGEPOINTS, RANGE = 25, 0.8
FLEXIBILITY, SEASONAL_SCALE = 0.05, 10.0
DAY, WEEK = 86400, 604800
ORDERS = ((DAY, 4), (WEEK, 3))
COLUMNS = sum(2 * k for _, k in ORDERS)
ROUNDS, SWEEPS = 2, 200
SAMPLES, SEED = 400, 0
TINY = 1e-9

S = np.arange(1, CHANGEPOINTS + 1) * RANGE / CHANGEPOINTS
CELLS = CHANGEPOINTS + 1


# columns of a row


def scaled_time(e: Column) -> Column:
    """Time over the fitted history: 0 at its first row, 1 at its last (0 if there is one time only)."""
    span = (F.col("e1") - F.col("e0")).cast("double")
    return F.when(span > 0, (e - F.col("e0")).cast("double") / span).otherwise(F.lit(0.0))


def cell(t: Column) -> Column:
    """Number of candidates at or before ``t``."""
    return F.least(F.floor(F.greatest(t, F.lit(0.0)) * F.lit(CHANGEPOINTS / RANGE)), F.lit(CHANGEPOINTS)).cast("int")


def trend_at(t: Column) -> Column:
    c = cell(t)
    return F.get("icpt", c) + F.get("slope", c) * t


def waves(e: Column) -> list[Column]:
    """The seasonal columns at epoch second ``e``; those of a period the history does not hold twice are 0."""
    out = []
    for period, order in ORDERS:
        held = (F.col("e1") - F.col("e0") >= 2 * period).cast("double")
        for k in range(1, order + 1):
            angle = F.pmod(e, F.lit(period)).cast("double") * F.lit(2.0 * np.pi * k / period)
            out += [F.sin(angle) * held, F.cos(angle) * held]
    return out


def season_at(e: Column) -> Column:
    total = F.lit(0.0)
    for i, x in enumerate(waves(e)):
        total = total + F.get("beta", F.lit(i)) * x
    return total


# the trend


def _moments(rows: DataFrame) -> DataFrame:
    """Per series an array of CELLS x 5 sums (weight, t, t^2, y, t y), and the sum of squares of y."""
    w = F.col("s") * F.col("s")
    sums = rows.groupBy("symbol", cell(F.col("t")).alias("cell")).agg(
        F.array(F.sum(w), F.sum(w * F.col("t")), F.sum(w * F.col("t") * F.col("t")), F.sum(F.col("s") * F.col("z")),
                F.sum(F.col("s") * F.col("z") * F.col("t"))).alias("m"), F.sum(F.col("z") * F.col("z")).alias("zz"), F.count("*").alias("n"))
    cells = sums.groupBy("symbol").agg(F.map_from_entries(F.collect_list(F.struct("cell", "m"))).alias("cells"),
                                       F.sum("zz").alias("zz"), F.sum("n").alias("n"))
    none = F.array(*[F.lit(0.0)] * 5)
    flat = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(CHANGEPOINTS)), lambda c: F.coalesce(F.try_element_at("cells", c), none)))
    return cells.select("symbol", flat.alias("moments"), "zz", "n")


def solve_trend(moments: np.ndarray, zz: np.ndarray, n: np.ndarray, sigma2: np.ndarray, flexibility: float = FLEXIBILITY,
                sweeps: int = SWEEPS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(slope and intercept of each cell, delta, sigma2 used) of a batch of series, by coordinate descent.

    ``moments``: batch x CELLS x 5. Where ``sigma2`` is NaN, the residual variance of one straight line is taken. Level and
    slope are not penalised; they are eliminated from the Gram matrix, so the descent is over ``delta`` alone.
    """
    after = np.cumsum(moments[:, ::-1], axis=1)[:, ::-1]  # sums over cells from each on
    w, t1, t2, y, ty = np.moveaxis(after, 2, 0)
    # inverse of the Gram matrix of level and slope
    det = w[:, 0] * t2[:, 0] - t1[:, 0] ** 2
    line = det > TINY * w[:, 0] * t2[:, 0]
    safe = np.where(line, det, 1.0)
    inv = np.zeros((len(w), 2, 2))
    inv[:, 0, 0] = np.where(line, t2[:, 0] / safe, 1.0 / w[:, 0])
    inv[:, 1, 1] = np.where(line, w[:, 0] / safe, 0.0)
    inv[:, 0, 1] = inv[:, 1, 0] = np.where(line, -t1[:, 0] / safe, 0.0)
    right = np.stack((y[:, 0], ty[:, 0]), 1)
    base = np.einsum("bij,bj->bi", inv, right)
    sse = np.maximum(zz - (base * right).sum(1), 0.0)
    sigma2 = np.where(np.isnan(sigma2), sse / n, sigma2)
    # hinge columns: with level and slope, with each other, with y
    cross = np.stack((t1[:, 1:] - S * w[:, 1:], t2[:, 1:] - S * t1[:, 1:]), 1)
    late = np.maximum.outer(np.arange(1, CELLS), np.arange(1, CELLS))
    gram = t2[:, late] - (S[:, None] + S) * t1[:, late] + S[:, None] * S * w[:, late]
    lifted = np.einsum("bij,bjc->bic", inv, cross)
    gram = gram - np.einsum("bic,bid->bcd", cross, lifted)
    goal = ty[:, 1:] - S * y[:, 1:] - np.einsum("bic,bi->bc", cross, base)
    penalty = sigma2 / flexibility
    delta = np.zeros_like(goal)
    diagonal = np.einsum("bcc->bc", gram)
    usable = diagonal > TINY * n[:, None]
    for _ in range(sweeps):
        for j in range(CHANGEPOINTS):
            r = goal[:, j] - (gram[:, j] * delta).sum(1) + diagonal[:, j] * delta[:, j]
            step = np.sign(r) * np.maximum(np.abs(r) - penalty, 0.0)
            delta[:, j] = np.where(usable[:, j], step / np.where(usable[:, j], diagonal[:, j], 1.0), 0.0)
    level = base - np.einsum("bic,bc->bi", lifted, delta)
    zero = np.zeros((len(delta), 1))
    slope = level[:, 1:] + np.concatenate((zero, np.cumsum(delta, 1)), 1)
    icpt = level[:, :1] - np.concatenate((zero, np.cumsum(delta * S, 1)), 1)
    return slope, icpt, delta, sigma2


def _trend_udf(flexibility: float, sweeps: int):
    def solve(moments: pd.Series, zz: pd.Series, n: pd.Series, sigma2: pd.Series) -> pd.DataFrame:
        m = np.stack(moments.to_numpy()).astype(float).reshape(len(moments), CELLS, 5) if len(moments) else np.zeros((0, CELLS, 5))
        out = solve_trend(m, zz.to_numpy(float), n.to_numpy(float), sigma2.to_numpy(float), flexibility, sweeps)
        return pd.DataFrame({"slope": list(out[0]), "icpt": list(out[1]), "delta": list(out[2]), "sigma2": out[3]})

    return F.pandas_udf(solve, "slope array<double>, icpt array<double>, delta array<double>, sigma2 double")


# the seasonality


def solve_spd(matrix: Column, size: int) -> Column:
    """Solution of a symmetric positive definite system, given as rows with the right side as last element."""
    at = lambda m, i, j: F.get(F.get(m, i), j)
    swept = F.aggregate(
        F.sequence(F.lit(0), F.lit(size - 1)), matrix,
        lambda m, k: F.transform(m, lambda r, i: F.when(i == k, F.transform(r, lambda x: x / at(m, k, k)))
                                 .otherwise(F.zip_with(r, F.get(m, k), lambda x, p: x - F.get(r, k) / at(m, k, k) * p))))
    return F.transform(swept, lambda r: F.get(r, F.lit(size)))


def _season(rows: DataFrame, params: DataFrame) -> DataFrame:
    """``symbol, beta, sigma2`` given the trend of ``params`` (and its ``sigma2``, for the ridge)."""
    g = trend_at(F.col("t"))
    rest = F.col("z") - g
    phase = rows.join(params, "symbol").groupBy("symbol", F.pmod(F.col("e"), F.lit(WEEK)).alias("e")).agg(
        F.sum(g * g).alias("gg"), F.sum(g * rest).alias("gr"), F.sum(rest * rest).alias("rr"), F.count("*").alias("n"),
        F.min("e0").alias("e0"), F.min("e1").alias("e1"))
    phase = phase.select("*", *[w.alias(f"x{i}") for i, w in enumerate(waves(F.col("e")))])
    # as texts, each parsed once: hundreds of column objects take longer to build than the sums to run
    pairs = [(i, j) for i in range(COLUMNS) for j in range(i, COLUMNS)]
    every = range(COLUMNS)
    sums = phase.groupBy("symbol").agg(
        F.expr("array(" + ", ".join(f"sum(gg * x{i} * x{j})" for i, j in pairs) + ")").alias("a"),
        F.expr("array(" + ", ".join(f"sum(gr * x{i})" for i in every) + ")").alias("b"), F.sum("rr").alias("rr"), F.sum("n").alias("n"))
    place = {p: i for i, p in enumerate(pairs)}
    square = "array(" + ", ".join("array(" + ", ".join(f"a[{place[min(i, j), max(i, j)]}]" for j in every) + ")" for i in every) + ")"
    system = (f"transform(gram, (r, i) -> concat(transform(r, (x, j) -> IF(i = j, x + sigma2 / {SEASONAL_SCALE ** 2!r}D + {TINY!r}D, x)), array(b[i])))")
    gain = ("aggregate(zip_with(zip_with(gram, beta, (r, x) -> struct(r, x)), b, (s, y) -> "
            "s.x * (aggregate(zip_with(s.r, beta, (u, v) -> u * v), 0D, (t, u) -> t + u) - 2 * y)), 0D, (t, u) -> t + u)")
    solved = (sums.join(params.select("symbol", "sigma2"), "symbol").withColumn("gram", F.expr(square))
              .select("symbol", "gram", "b", "rr", "n", solve_spd(F.expr(system), COLUMNS).alias("beta")))
    return solved.select("symbol", "beta", (F.greatest(F.col("rr") + F.expr(gain), F.lit(0.0)) / F.col("n")).alias("sigma2"))


# the fit


def _fit_rows(train: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows to fit (``symbol, e, t, z``) and the scales of each series (``symbol, e0, e1, ymax``)."""
    usable = F.col("y").isNotNull() & ~F.isnan("y") & (F.abs(F.col("y")) < F.lit(float("inf")))
    rows = train.where(usable).select("symbol", epoch_seconds("ds").alias("e"), "y")
    scales = rows.groupBy("symbol").agg(F.min("e").alias("e0"), F.max("e").alias("e1"),
                                        F.max(F.abs(F.col("y"))).alias("ymax"))
    scales = scales.withColumn("ymax", F.when(F.col("ymax") > 0, F.col("ymax")).otherwise(F.lit(1.0)))
    scaled = rows.join(scales, "symbol").select("symbol", "e", "e0", "e1", scaled_time(F.col("e")).alias("t"), (F.col("y") / F.col("ymax")).alias("z"))
    return scaled, scales


def fit_changepoints(train: DataFrame, flexibility: float = FLEXIBILITY, rounds: int = ROUNDS, sweeps: int = SWEEPS,
                     seasonal: bool = True) -> DataFrame:
    """One row a series: ``symbol, e0, e1, ymax, slope, icpt, delta, beta, sigma2`` (scaled units; slope and intercept per cell).

    ``train`` (``symbol, ds, y``) is read once for the scales and twice a round; give a stored frame.
    """
    rows, scales = _fit_rows(train)
    solve = _trend_udf(flexibility, sweeps)
    none = F.array(*[F.lit(0.0)] * COLUMNS)
    season = None
    for _ in range(rounds if seasonal else 1):
        if season is None:
            moments = _moments(rows.withColumn("s", F.lit(1.0))).withColumn("sigma2", F.lit(float("nan")))
        else:
            moments = _moments(rows.join(season.select("symbol", "beta"), "symbol").withColumn("s", 1 + season_at(F.col("e"))))
            moments = moments.join(season.select("symbol", "sigma2"), "symbol")
        trend = materialize(moments.select("symbol", solve("moments", "zz", "n", "sigma2").alias("f")).select("symbol", "f.*"))
        if not seasonal:
            return scales.join(trend, "symbol").withColumn("beta", none)
        season = materialize(_season(rows, trend))
    return scales.join(trend.drop("sigma2"), "symbol").join(season, "symbol")


def _scored(frame: DataFrame) -> DataFrame:
    e = epoch_seconds("ds")
    frame = frame.withColumn("_e", e).withColumn("_t", scaled_time(F.col("_e")))
    frame = frame.withColumn("trend", F.col("ymax") * trend_at(F.col("_t"))).withColumn("seasonal", season_at(F.col("_e")))
    return frame.withColumn("yhat", F.col("trend") * (1 + F.col("seasonal")))


def future_rows(params: DataFrame, last: DataFrame, periods: int, step_seconds: int) -> DataFrame:
    """One row a future step: parameters, ``ds`` and the step's number ``_h``; ``last``: ``symbol, ds`` of each series' end."""
    ahead = last.join(params, "symbol").select("*", F.explode(F.sequence(F.lit(1), F.lit(int(periods)))).alias("_h"))
    return ahead.withColumn("ds", F.timestamp_add("SECOND", F.col("_h").cast("long") * int(step_seconds), F.col("ds")))


def components(train: DataFrame, params: DataFrame, periods: int = HORIZON_HOURS, step_seconds: int = 3600) -> DataFrame:
    """``symbol, ds, y, yhat, trend, seasonal`` of the training times and ``periods`` future ones (``y`` null)."""
    last = train.groupBy("symbol").agg(F.max("ds").alias("ds"))
    cols = ["symbol", "ds", "y", "yhat", "trend", "seasonal"]
    history = _scored(train.select("symbol", "ds", "y").join(params, "symbol")).select(*cols)
    if periods <= 0:
        return history
    future = _scored(future_rows(params, last, periods, step_seconds)).withColumn("y", F.lit(None).cast("double"))
    return history.unionByName(future.select(*cols))


# the band


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well-mixed 64 bits of each number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniforms(key: int, samples: int, periods: int, stream: int) -> np.ndarray:
    """samples x periods numbers in (0, 1): hashes of (key, stream, sample, step)."""
    at = np.arange(samples, dtype=np.uint64)[:, None] * np.uint64(1 << 32) + np.arange(periods, dtype=np.uint64)
    seed = _mixed(np.array([key & (2 ** 64 - 1)], np.uint64) + np.uint64(stream + 1) * np.uint64(0x2545F491))
    return (_mixed(_mixed(at + np.uint64(1)) ^ seed) >> np.uint64(11)).astype(float) / 2.0 ** 53 + 2.0 ** -54


def simulated_band(key: int, step: float, scale: float, sigma: float, factor: np.ndarray, level: float, samples: int) -> tuple[np.ndarray, np.ndarray]:
    """Quantiles at each future step of what trend breaks and noise add to the point forecast (scaled units).

    ``step`` is a step in scaled time, ``scale`` the mean absolute change at a candidate, ``factor`` the seasonal factor of each
    step. A step holds a break with the rate of the candidates; its change is Laplace distributed.
    """
    periods = len(factor)
    rate = min(1.0, CHANGEPOINTS * step)
    happens = uniforms(key, samples, periods, 0) < rate
    u = uniforms(key, samples, periods, 1) - 0.5
    change = np.where(happens, -scale * np.sign(u) * np.log1p(-2.0 * np.abs(u)), 0.0)
    drift = np.cumsum(np.cumsum(change, 1), 1) * step  # a break at a step bends the trend from that step on
    radius = np.sqrt(-2.0 * np.log(uniforms(key, samples, periods, 2)))
    noise = radius * np.cos(2.0 * np.pi * uniforms(key, samples, periods, 3))
    spread = drift * factor + sigma * noise
    return tuple(np.quantile(spread, [(1 - level) / 2, (1 + level) / 2], axis=0))


def _band_udf(samples: int, level: float):
    def band(key: pd.Series, step: pd.Series, scale: pd.Series, sigma: pd.Series, factor: pd.Series) -> pd.DataFrame:
        out = [simulated_band(int(k), h, s, d, np.asarray(f, float), level, samples) for k, h, s, d, f in zip(key, step, scale, sigma, factor)]
        return pd.DataFrame({"lower": [a for a, _ in out], "upper": [b for _, b in out]})

    return F.pandas_udf(band, "lower array<double>, upper array<double>")


def forecast_changepoint(train: DataFrame, periods: int = HORIZON_HOURS, step_seconds: int = 3600, params: DataFrame | None = None,
                         samples: int = SAMPLES, seed: int = SEED, level: float = 0.8) -> DataFrame:
    """Forecast with trend breaks, smooth seasonality and a band that widens.

    ``symbol, ds, y, yhat, yhat_lower, yhat_upper``: training times and ``periods`` future ones. ``train`` should be
    stored. ``level`` is the band's share; the same ``seed`` gives the same band.
    """
    params = fit_changepoints(train) if params is None else params
    cols = ["symbol", "ds", "y", "yhat", "yhat_lower", "yhat_upper"]
    z = Z80 if level == 0.8 else NormalDist().inv_cdf((1 + level) / 2)
    half = F.lit(z) * F.sqrt("sigma2") * F.col("ymax")
    history = _scored(train.select("symbol", "ds", "y").join(params, "symbol"))
    history = history.withColumns({"yhat_lower": F.col("yhat") - half, "yhat_upper": F.col("yhat") + half}).select(*cols)
    if periods <= 0:
        return history
    last = train.groupBy("symbol").agg(F.max("ds").alias("ds"))
    e = epoch_seconds("ds")
    steps = F.sequence(F.lit(1), F.lit(int(periods)))
    span = (F.col("e1") - F.col("e0")).cast("double")
    one = last.join(params, "symbol").select(
        "symbol", F.xxhash64(F.lit(int(seed)), "symbol").alias("key"),
        F.when(span > 0, F.lit(float(step_seconds)) / span).otherwise(F.lit(0.0)).alias("step"),
        F.aggregate("delta", F.lit(0.0), lambda a, d: a + F.abs(d), lambda a: a / F.lit(float(CHANGEPOINTS))).alias("scale"),
        F.sqrt("sigma2").alias("sigma"),
        F.transform(steps, lambda h: 1 + season_at(e + h.cast("long") * F.lit(int(step_seconds)))).alias("factor"))
    band = one.select("symbol", _band_udf(samples, level)("key", "step", "scale", "sigma", "factor").alias("b")).select("symbol", "b.*")
    future = _scored(future_rows(params, last, periods, step_seconds)).join(band, "symbol")
    bound = lambda c: F.col("yhat") + F.col("ymax") * F.get(c, F.col("_h") - 1)
    future = future.select("symbol", "ds", F.lit(None).cast("double").alias("y"), "yhat", bound("lower").alias("yhat_lower"), bound("upper").alias("yhat_upper"))
    return history.unionByName(future)


def changes(params: DataFrame) -> DataFrame:
    """Breaks that the fit found: ``symbol, ds, delta`` (change of slope per hour, in units of y)."""
    hour = F.when(F.col("e1") > F.col("e0"), F.lit(3600.0) / (F.col("e1") - F.col("e0"))).otherwise(F.lit(0.0))
    d = params.select("symbol", "e0", "e1", (F.col("ymax") * hour).alias("unit"), F.posexplode("delta").alias("j", "d")).where("d <> 0")
    at = F.col("e0") + F.round((F.col("j") + 1) * F.lit(RANGE / CHANGEPOINTS) * (F.col("e1") - F.col("e0"))).cast("long")
    return d.select("symbol", F.timestamp_add("SECOND", at, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).alias("ds"),
                    (F.col("d") * F.col("unit")).alias("delta"))
