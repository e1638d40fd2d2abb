"""Automatic ARIMA with moving-average terms per series (M5, ``auto_arima``, max order 5).

Series are handled in blocks of some hundred, as columns of arrays (``series_blocks``, ``arima_blocks``):

1. the order ``d`` of differencing, by a KPSS test of the series and its
   differences; the long-run variance is prewhitened by an
   AR(1), so a strongly correlated but stationary series is not differenced;
2. Hannan-Rissanen, first stage: a long autoregression by normal equations, whose residuals
   stand for the innovations;
3. second stage: one Gram matrix of the lags of the series and of these residuals per
   series. Every ARMA(p, q) with ``p + q <= 5`` is a submatrix of it, so all 21 are solved at once for a batch of series and compared by
   AICc. A model is only preferred to a smaller one if its AICc is less by PARSIMONY.

Only then conditional least squares (Gauss-Newton on the innovations, which follows the recursion through the ordered
series) refines the few best orders of a series (CANDIDATES) and, step by step, the neighbours of the best by AICc;
forecasts and bands follow from the psi weights. ``arima_model`` refines a block's series together, ``forecast_arima`` one Python group a
series; the size of a series is the number of hours.

Missing and infinite values are put on the line between their neighbours before that step; in the sums, rows with a
missing lag are left out. Defined cases: a series too short for the long autoregression gets ARIMA(0, d, 0);
a constant one its value with no spread; ties in AICc go to fewer terms, then to fewer moving-average terms.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratecast.operators.ar_auto import EXPLAIN_SCHEMA, complete
from ratecast.operators.arima_blocks import EXACT, arma_columns, kpss_values, least_squares, regressors, residuals
from ratecast.operators.arima_blocks import css as blockwise_css
from ratecast.operators.changepoint import solve_spd
from ratecast.operators.forecast import Z80, cluster_series
from ratecast.operators.series_blocks import columns, dot, first_of, gram, inside, like_lengths, map_series, solve, together, types, values
from ratecast.operators.training import HORIZON_HOURS

# Fixed values of the order search.
MAX_ORDER, MAX_D = 5, 2
LONG = 12          # lags of the first-stage autoregression
KPSS_LAGS = 12     # lags of the long-run variance at most
KPSS_CRITICAL = 0.739  # level stationarity, 1 %
PARSIMONY = 6.0
CANDIDATES = 3
FEW = 4            # series up to which they are refined one by one
RIDGE = 1e-9
CODE = (MAX_ORDER + 1) ** 2 + 1  # numbers of an order of (p, q), with none

ORDERS = sorted(((p, q) for p in range(MAX_ORDER + 1) for q in range(MAX_ORDER + 1 - p)), key=lambda o: (sum(o), o[1]))


# differencing


def _differenced(lagged: list[Column], d: int) -> list[Column]:
    """Lags 0, 1, ... of the d-th difference from lags of the series."""
    for _ in range(d):
        lagged = [a - b for a, b in zip(lagged, lagged[1:])]
    return lagged


def _lags(frame: DataFrame, value: str, n: int, prefix: str) -> DataFrame:
    w = Window.partitionBy("symbol").orderBy("ds")
    return frame.select("*", *[F.lag(value, k).over(w).alias(f"{prefix}{k}") for k in range(1, n + 1)])


def _usable(train: DataFrame) -> DataFrame:
    """Rows with a finite value."""
    return train.where(F.col("y").isNotNull() & ~F.isnan("y") & (F.abs(F.col("y")) < F.lit(float("inf"))))


def _centred(train: DataFrame, tasks: int | None = None) -> DataFrame:
    """``symbol, ds, x``: finite values less the series' mean."""
    rows = cluster_series(_usable(train).select("symbol", "ds", "y"), tasks)
    w = Window.partitionBy("symbol").orderBy("ds").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.select("symbol", "ds", (F.col("y") - F.avg("y").over(w)).alias("x"))


def kpss_statistics(train: DataFrame, tasks: int | None = None) -> DataFrame:
    """``symbol, d, n, kpss`` for d = 0 .. MAX_D: KPSS level statistic with an AR(1)-prewhitened long-run variance."""

    def statistics(table: pa.Table, cuts: np.ndarray) -> pa.RecordBatch:
        y, start, n = values(table, "y"), cuts[:-1], np.diff(cuts)
        kpss = np.zeros((MAX_D + 1, len(n)))
        for some in like_lengths(n):
            x = columns(y, start[some], n[some])
            x = (x - x.sum(0) / n[some]) * inside(n[some], len(x))
            for d in range(MAX_D + 1):
                left = np.maximum(n[some] - d, 0)
                kpss[d, some] = kpss_values(np.diff(x, n=d, axis=0) * inside(left, max(len(x) - d, 0)), left, KPSS_LAGS, RIDGE * RIDGE)
        d, of = np.nonzero(n > np.arange(MAX_D + 1)[:, None])
        return pa.RecordBatch.from_arrays([first_of(table, "symbol", start[of]), pa.array(d.astype(np.int32)),
                                           pa.array((n[of] - d).astype(np.int64)), pa.array(kpss[d, of])], names=["symbol", "d", "n", "kpss"])

    return map_series(together(_usable(train), tasks, "y"), statistics, types(train, "symbol") + ", d int, n long, kpss double")


def differencing(train: DataFrame, critical: float = KPSS_CRITICAL, tasks: int | None = None) -> DataFrame:
    """``symbol, d``: the least order whose difference passes the test (MAX_D if none does)."""
    passed = F.min(F.when(F.col("kpss") < critical, F.col("d")))
    return kpss_statistics(train, tasks).groupBy("symbol").agg(F.coalesce(passed, F.lit(MAX_D)).alias("d"))


# Hannan-Rissanen


def _gram(rows: DataFrame, columns: list[str], target: str) -> DataFrame:
    """Per series the rows of the Gram matrix of ``columns`` with the products with ``target`` as last element, and ``yy, n``."""
    x = [F.col(c) for c in columns]
    pairs = [(i, j) for i in range(len(x)) for j in range(i, len(x))]
    place = {p: i for i, p in enumerate(pairs)}
    sums = rows.groupBy("symbol").agg(F.array(*[F.sum(x[i] * x[j]) for i, j in pairs]).alias("a"), F.array(*[F.sum(c * F.col(target)) for c in x]).alias("b"),
                                      F.sum(F.col(target) * F.col(target)).alias("yy"), F.count("*").alias("n"))
    entry = lambda i, j: F.get("a", F.lit(place[min(i, j), max(i, j)]))
    return sums.select("symbol", F.array(*[F.array(*[entry(i, j) for j in range(len(x))], F.get("b", F.lit(i))) for i in range(len(x))]).alias("gram"), "yy", "n")


def _ridged(gram: Column) -> Column:
    """A little on the diagonal, in proportion to it: lags of a constant series are no system otherwise."""
    return F.transform(gram, lambda r, i: F.transform(r, lambda x, j: F.when(i == j, x * (1 + RIDGE) + RIDGE).otherwise(x)))


def innovations(differenced: DataFrame, lags: int = LONG, tasks: int | None = None) -> DataFrame:
    """``symbol, ds, place, w, e``: residuals of the autoregression of ``lags`` terms with a constant (first stage); the first rows have none."""

    def fit(table: pa.Table, cuts: np.ndarray) -> pa.RecordBatch:
        flat, start, n = values(table, "w"), cuts[:-1], np.diff(cuts)
        e, known = np.zeros(len(flat)), np.zeros(len(flat), bool)
        for some in like_lengths(n):
            w = columns(flat, start[some], n[some])
            x = regressors(w, n[some], lags, lags)
            left = residuals(x, w, least_squares(x, w, RIDGE)[0])
            t, of = np.nonzero(x[0])
            e[start[some][of] + t], known[start[some][of] + t] = left[t, of], True
        return pa.RecordBatch.from_arrays([*[table.column(c).combine_chunks() for c in ("symbol", "ds", "place", "w")], pa.array(e, mask=~known)], names=["symbol", "ds", "place", "w", "e"])

    return map_series(together(differenced, tasks, "w"), fit, types(differenced, "symbol", "ds") + ", place int, w double, e double")


def difference(train: DataFrame, orders: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """``symbol, ds, w``: each series differenced as often as ``orders`` (``symbol, d``) says (not at all if not given)."""
    rows = _lags(_centred(train, tasks), "x", MAX_D, "x")
    if orders is None:
        return rows.select("symbol", "ds", F.col("x").alias("w"))
    lagged = [F.col("x"), F.col("x1"), F.col("x2")]
    w = [_differenced(lagged, d)[0] for d in range(MAX_D + 1)]
    return rows.join(orders, "symbol").select("symbol", "ds", "d", F.when(F.col("d") == 0, w[0]).when(F.col("d") == 1, w[1]).otherwise(w[2]).alias("w")) \
        .where("w IS NOT NULL").select("symbol", "ds", "w")


def arma_gram(residuals: DataFrame, order: int = MAX_ORDER) -> DataFrame:
    """``symbol, gram, yy, n``: rows of the Gram matrix of a constant and ``order`` lags of the series and of the innovations, with the
    products with the series as last element (second stage); the rows are those of ``innovations`` as they lie."""

    def sums(table: pa.Table, cuts: np.ndarray) -> pa.RecordBatch:
        flat, noise, start, n = values(table, "w"), values(table, "e"), cuts[:-1], np.diff(cuts)
        missing = np.add.reduceat(np.isnan(noise), start)  # the first rows
        found: list[list] = [[], [], [], []]
        for some in like_lengths(n):
            w, e = columns(flat, start[some], n[some]), columns(np.nan_to_num(noise), start[some], n[some])
            x = arma_columns(w, e, n[some], order, 0)
            rows = np.where(np.arange(len(w))[:, None] >= missing[some] + order, x[0], 0.0)
            x = [c * rows for c in x]
            full = np.concatenate((gram(x), np.stack([dot(c, w) for c in x])[:, None]), 1)
            count = rows.sum(0).astype(np.int64)
            of = np.flatnonzero(count)
            for to, part in zip(found, (start[some][of], full[:, :, of].transpose(2, 0, 1), dot(w * rows, w)[of], count[of])):
                to.extend(part)
        return pa.RecordBatch.from_arrays([first_of(table, "symbol", np.array(found[0], np.int64)), pa.array([m.tolist() for m in found[1]], pa.list_(pa.list_(pa.float64()))),
                                           pa.array(found[2], pa.float64()), pa.array(found[3], pa.int64())], names=["symbol", "gram", "yy", "n"])

    return map_series(residuals.select("symbol", "place", "w", "e"), sums, types(residuals, "symbol") + ", gram array<array<double>>, yy double, n long")


def hannan_rissanen(differenced: DataFrame, p: int, q: int, lags: int = LONG) -> DataFrame:
    """``symbol, const, phi, theta, sigma2, n`` of ARMA(p, q) by two least-squares stages; ``differenced``: ``symbol, ds, w``."""
    order = max(p, q, 1)
    rows = _lags(_lags(innovations(differenced, lags), "w", order, "w"), "e", order, "e").withColumn("one", F.lit(1.0))
    columns = ["one", *[f"w{k}" for k in range(1, p + 1)], *[f"e{k}" for k in range(1, q + 1)]]
    g = _gram(rows.where(F.col(f"e{order}").isNotNull()), columns, "w")
    g = g.withColumn("a", solve_spd(_ridged(F.col("gram")), len(columns)))
    explained = F.lit(0.0)
    for i in range(len(columns)):
        explained = explained + F.get("a", F.lit(i)) * F.get(F.get("gram", F.lit(i)), F.lit(len(columns)))
    return g.select("symbol", F.get("a", F.lit(0)).alias("const"), F.slice("a", 2, p).alias("phi"), F.slice("a", 2 + p, q).alias("theta"),
                    (F.greatest(F.col("yy") - explained, F.lit(0.0)) / F.col("n")).alias("sigma2"), "n")


def aicc(sse: np.ndarray, n: np.ndarray, terms: int) -> np.ndarray:
    """``terms``: coefficients with the constant; the variance is one more."""
    k = terms + 1
    return n * np.log(np.maximum(sse / n, 1e-300)) + 2 * k + 2 * k * (k + 1) / np.maximum(n - k - 1, 1)


def parsimonious(scores: dict[tuple[int, int], float]) -> tuple[int, int]:
    """The smallest order (fewer terms, then fewer moving-average terms) whose score is within PARSIMONY of the least."""
    least = min(scores.values())
    return min((o for o, s in scores.items() if s <= least + PARSIMONY), key=lambda o: (sum(o), o[1]))


def rank_orders(gram: np.ndarray, yy: np.ndarray, n: np.ndarray) -> list[list[tuple[int, int]]]:
    """The CANDIDATES orders of each series of a batch, from their Gram matrices (batch x 11 x 12): the parsimonious one, then by AICc."""
    size = gram.shape[1]
    a, b = gram[:, :, :size].copy(), gram[:, :, size]
    ridge = RIDGE * np.einsum("bii->bi", a) + RIDGE
    a[:, np.arange(size), np.arange(size)] += ridge
    scores = []
    for p, q in ORDERS:
        at = [0, *range(1, p + 1), *range(MAX_ORDER + 1, MAX_ORDER + 1 + q)]
        s = np.linalg.solve(a[:, at][:, :, at], b[:, at][:, :, None])[:, :, 0]
        scores.append(aicc(np.maximum(yy - (s * b[:, at]).sum(1), 0.0), n, len(at)))
    table = np.stack(scores, 1)
    out = []
    for row in table:
        by = dict(zip(ORDERS, row))
        best = [parsimonious(by)]
        best += [o for o in sorted(by, key=by.get) if o not in best]
        out.append(best[:CANDIDATES])
    return out


# conditional least squares of one series


def _inverse(theta: np.ndarray, n: int) -> np.ndarray:
    """Weights of 1 / (1 + theta_1 B + ...), as many as matter: the first by the recursion, then each turn doubles them."""
    q = theta.size
    if not q:
        return np.ones(1)
    t, first = theta.tolist(), [1.0]
    for k in range(1, 16):
        first.append(-sum([c * x for c, x in zip(t, first[k - 1::-1])]))
    poly, h = np.concatenate(([1.0], theta)), np.array(first)
    while len(h) < n and np.abs(h[-q:]).max() >= 1e-10:
        rest = np.convolve(poly, h)[len(h):]  # what the product has beyond 1
        h = np.concatenate((h, -np.convolve(h, rest)[:len(h)]))
    h = h[:n]
    large = np.flatnonzero(np.abs(h) >= 1e-10)
    runs = np.flatnonzero(np.diff(large, append=len(h)) > q)  # the first of these is followed by q that don't matter
    return h[:large[runs[0]] + q + 1] if len(runs) else h


def _rooted_outside(coef: np.ndarray) -> bool:
    """Whether 1 + coef_1 z + ... has all roots clear of the unit circle: all reflection coefficients are below 1."""
    a, scale = [], 1.0
    for c in coef.tolist():
        scale *= 1.001
        a.append(c * scale)
    while a:
        k = a.pop()
        if not abs(k) < 1:
            return False
        a = [(x - k * y) / (1 - k * k) for x, y in zip(a, reversed(a))]
    return True


def _filtered(x: np.ndarray, h: np.ndarray) -> np.ndarray:
    return np.convolve(x, h)[:len(x)]


def css(w: np.ndarray, p: int, q: int, start: np.ndarray | None = None, steps: int = 12) -> tuple[np.ndarray, float, int]:
    """(constant, phi, theta), sum of squares and number of innovations; innovations before the MAX_ORDER-th are not counted.

    Gauss-Newton with halved steps that keep both polynomials' roots outside the unit circle.
    """
    n, skip = len(w), MAX_ORDER
    beta = np.zeros(1 + p + q) if start is None else start.astype(float).copy()
    if start is None or not (_rooted_outside(-beta[1:1 + p]) and _rooted_outside(beta[1 + p:])):
        beta[:] = 0.0
        beta[0] = w.mean()
    lagged = np.zeros((p, n))
    for i in range(p):
        lagged[i, i + 1:] = w[:n - i - 1]

    def innovations_of(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        u = w - b[0] - b[1:1 + p] @ lagged
        u[:p] = 0.0
        h = _inverse(b[1 + p:], n)
        return _filtered(u, h), h

    e, h = innovations_of(beta)
    sse = float(e[skip:] @ e[skip:])
    for _ in range(steps):
        ones = np.ones(n)
        ones[:p] = 0.0
        grad = [_filtered(ones, h)]
        for i in range(p):
            x = lagged[i].copy()
            x[:p] = 0.0
            grad.append(_filtered(x, h))
        back = _filtered(e, h)
        for j in range(q):
            grad.append(np.concatenate((np.zeros(j + 1), back[:n - j - 1])))
        g = np.stack(grad, 1)[skip:]
        step = np.linalg.lstsq(g, e[skip:], rcond=None)[0]
        scale, better = 1.0, False
        while scale > 1e-3:
            new = beta + scale * step
            if _rooted_outside(-new[1:1 + p]) and _rooted_outside(new[1 + p:]):
                e2, h2 = innovations_of(new)
                sse2 = float(e2[skip:] @ e2[skip:])
                if sse2 < sse:
                    better = True
                    break
            scale /= 2
        if not better:
            break
        gain = sse - sse2
        beta, e, h, sse = new, e2, h2, sse2
        if gain < 1e-6 * sse:
            break
    return beta, sse, n - skip


def long_residuals(w: np.ndarray, lags: int = LONG) -> np.ndarray:
    """Residuals of the long autoregression of one series, the first ``lags`` 0."""
    n = len(w)
    e = np.zeros(n)
    if n > 3 * lags:
        x = np.column_stack([np.ones(n - lags)] + [w[lags - k:n - k] for k in range(1, lags + 1)])
        e[lags:] = w[lags:] - x @ np.linalg.lstsq(x, w[lags:], rcond=None)[0]
    return e


def second_stage(w: np.ndarray, e: np.ndarray, p: int, q: int) -> np.ndarray:
    """Hannan-Rissanen estimate of one series: constant, p and q coefficients."""
    s, n = min(LONG + MAX_ORDER, len(w) // 2), len(w)
    x = np.column_stack([np.ones(n - s)] + [w[s - k:n - k] for k in range(1, p + 1)] + [e[s - k:n - k] for k in range(1, q + 1)])
    return np.linalg.lstsq(x, w[s:], rcond=None)[0]


def neighbours(order: tuple[int, int]) -> list[tuple[int, int]]:
    """Orders one term away in p, in q or in both."""
    p, q = order
    near = [(p + i, q + j) for i, j in ((-1, 0), (0, -1), (1, 0), (0, 1), (-1, -1), (1, 1), (-1, 1), (1, -1))]
    return [(a, b) for a, b in near if a >= 0 and b >= 0 and a + b <= MAX_ORDER]


def refined(w: np.ndarray, candidates: list[tuple[int, int]]) -> tuple[int, int, np.ndarray, float]:
    """(p, q, coefficients, variance): stepwise by AICc of conditional least squares, from the candidates and the smallest orders."""
    fits, scores, e = {}, {}, long_residuals(w)

    def try_(order: tuple[int, int]) -> None:
        p, q = order
        if order in scores or len(w) < MAX_ORDER + p + q + 4:
            return
        beta, sse, n = css(w, p, q, second_stage(w, e, p, q))
        fits[order], scores[order] = (beta, sse / n), float(aicc(np.array(sse), np.array(float(n)), 1 + p + q))

    for order in [*candidates, (0, 0), (1, 0), (0, 1)]:
        try_(order)
    best = None
    while scores and best != min(scores, key=scores.get):
        best = min(scores, key=scores.get)
        for order in neighbours(best):
            try_(order)
    if not fits:
        mean = w.mean() if w.size else 0.0
        return 0, 0, np.array([mean]), float(((w - mean) ** 2).mean()) if w.size else 0.0
    p, q = parsimonious(scores)
    return p, q, *fits[p, q]


def refined_all(series: list[np.ndarray], candidates: list[list[tuple[int, int]]]) -> list[tuple[int, int, np.ndarray, float]]:
    """``refined`` of each series, fitted together with all that try the same order; those that are short, few of their length,
    constant or fitted without an error (where rounding decides) one by one."""
    n = np.array([len(w) for w in series], np.int64)
    out: list[tuple[int, int, np.ndarray, float] | None] = [None] * len(series)
    for some in like_lengths(n):
        some = some[n[some] > 3 * LONG]
        if len(some) > FEW:
            for k, found in zip(some, _refined_block([series[k] for k in some], [candidates[k] for k in some])):
                out[k] = found
    return [found or refined(w, c) for found, w, c in zip(out, series, candidates)]


def _refined_block(series: list[np.ndarray], candidates: list[list[tuple[int, int]]]) -> list[tuple[int, int, np.ndarray, float] | None]:
    """``refined`` of series of like length; None where a system is near singular or a fit is exact."""
    n = np.array([len(w) for w in series], np.int64)
    # a constant is a term of every model, so the mean may be taken off first
    mean = np.array([w.mean() for w in series])
    w = columns(np.concatenate([x - m for x, m in zip(series, mean)]), np.cumsum(n) - n, n)
    long = regressors(w, n, LONG, LONG)
    a, sound = least_squares(long, w)
    sound &= dot(w, w) > EXACT * n * mean * mean
    x = arma_columns(w, residuals(long, w, a), n, MAX_ORDER, LONG + MAX_ORDER)
    products, right = gram(x), np.stack([dot(c, w) for c in x])
    fits: list[dict] = [{} for _ in series]
    scores: list[dict] = [{} for _ in series]

    def try_(wanted: dict[tuple[int, int], list[int]]) -> None:
        for (p, q), places in wanted.items():
            k = np.array(places)
            at = [0, *range(1, p + 1), *range(MAX_ORDER + 1, MAX_ORDER + 1 + q)]
            start, able = solve(products[np.ix_(at, at, k)], right[np.ix_(at, k)])
            sound[k[~able]] = False
            k, start = k[able], start[:, able]
            beta, sse, good = blockwise_css(w[:, k], n[k], p, q, start, MAX_ORDER) if len(k) else (start, np.empty(0), np.empty(0, bool))
            sound[k[~good]] = False
            beta[0] += mean[k] * (1 - beta[1:1 + p].sum(0))
            left = n[k] - MAX_ORDER
            for i, b, s, m, score in zip(k, beta.T, sse, left, aicc(sse, left.astype(float), 1 + p + q)):
                fits[i][p, q], scores[i][p, q] = (b, float(s / m)), float(score)

    def wanted(orders: dict[int, list[tuple[int, int]]]) -> dict[tuple[int, int], list[int]]:
        by: dict[tuple[int, int], list[int]] = {}
        for i, some in orders.items():
            for o in dict.fromkeys(some):
                if sound[i] and o not in scores[i]:
                    by.setdefault(o, []).append(i)
        return by

    try_(wanted({i: [*c, (0, 0), (1, 0), (0, 1)] for i, c in enumerate(candidates)}))
    best: dict[int, tuple[int, int]] = {}
    while True:
        least = {i: min(scores[i], key=scores[i].get) for i in np.flatnonzero(sound).tolist()}
        moved = {i: o for i, o in least.items() if best.get(i) != o}
        if not moved:
            break
        best |= moved
        try_(wanted({i: neighbours(o) for i, o in moved.items()}))
    chosen = [parsimonious(scores[i]) if sound[i] else None for i in range(len(series))]
    return [None if o is None else (*o, *fits[i][o]) for i, o in enumerate(chosen)]


def psi_weights(phi: np.ndarray, theta: np.ndarray, d: int, n: int) -> np.ndarray:
    """Weights of past innovations in the level, from phi(B) (1 - B)^d and theta(B)."""
    poly = np.concatenate(([1.0], -phi))
    for _ in range(d):
        poly = np.convolve(poly, [1.0, -1.0])
    psi = np.zeros(n)
    for j in range(n):
        psi[j] = (1.0 if j == 0 else theta[j - 1] if j <= len(theta) else 0.0) - sum(poly[i] * psi[j - i] for i in range(1, min(j, len(poly) - 1) + 1))
    return psi


def forecast_levels(y: np.ndarray, d: int, p: int, q: int, beta: np.ndarray, periods: int) -> np.ndarray:
    """Point forecasts of the level."""
    w = np.diff(y, n=d)
    phi, theta = beta[1:1 + p], beta[1 + p:]
    u = w - beta[0] - sum(c * np.concatenate((np.zeros(i + 1), w[:len(w) - i - 1])) for i, c in enumerate(phi)) if len(w) else w
    if len(w):
        u[:p] = 0.0
    e = _filtered(u, _inverse(theta, max(len(w), 1))) if len(w) else w
    past, noise = list(w), list(e)
    for _ in range(periods):
        past.append(beta[0] + sum(c * past[-1 - i] for i, c in enumerate(phi) if i < len(past)) + sum(c * noise[-1 - j] for j, c in enumerate(theta) if j < len(noise)))
        noise.append(0.0)
    levels = np.array(past[len(w):])
    for k in range(d, 0, -1):
        levels = np.diff(y, n=k - 1)[-1] + np.cumsum(levels)
    return levels


# the operators


def order_candidates(train: DataFrame, tasks: int | None = None) -> DataFrame:
    """``symbol, d, candidates`` (array of ``struct<p, q>``); series too short for the search have no candidates."""
    orders = differencing(train, tasks=tasks)
    gram = arma_gram(innovations(difference(train, orders, tasks), tasks=tasks))

    def rank(gram: pd.Series, yy: pd.Series, n: pd.Series) -> pd.Series:
        g = np.array([[list(r) for r in m] for m in gram], float)
        found = rank_orders(g, yy.to_numpy(float), n.to_numpy(float)) if len(g) else []
        return pd.Series([[{"p": p, "q": q} for p, q in c] for c in found])

    ranked = gram.where(F.col("n") > 4 * MAX_ORDER).select("symbol", F.pandas_udf(rank, "array<struct<p:int,q:int>>")("gram", "yy", "n").alias("candidates"))
    return orders.join(ranked, "symbol", "left")


MODEL = "symbol string, p int, d int, q int, const double, phi array<double>, theta array<double>, sigma2 double"


def _one(y: np.ndarray, d: int, candidates) -> tuple[int, int, np.ndarray, float]:
    tried = [(c["p"], c["q"]) for c in candidates] if isinstance(candidates, (list, np.ndarray)) else []
    return refined(np.diff(y, n=d), tried)


def _with_orders(train: DataFrame, tasks: int | None = None) -> DataFrame:
    """``symbol, ds, y, d, tried``, dealt by series."""
    n = tasks or int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # candidates come with every row: as one number, which Python reads at once for all rows of a series
    tried = F.aggregate("candidates", F.lit(0).cast("long"), lambda a, c: a * CODE + c["p"] * (MAX_ORDER + 1) + c["q"] + 1)
    orders = order_candidates(train, tasks).select("symbol", "d", tried.alias("tried"))
    return train.select("symbol", "ds", "y").join(orders, "symbol", "left").repartition(n, "symbol")


def _decoded(tried: float | None) -> list[dict[str, int]]:
    out, left = [], 0 if pd.isna(tried) else int(tried)
    while left:
        left, code = divmod(left, CODE)
        p, q = divmod(code - 1, MAX_ORDER + 1)
        out.append({"p": p, "q": q})
    return out[::-1]


def _series(rows: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, int, list[dict[str, int]]]:
    rows = rows.sort_values("ds")
    y = complete(rows["y"].to_numpy(dtype=float))
    d = 0 if pd.isna(rows["d"].iloc[0]) else int(rows["d"].iloc[0])
    return rows, y, min(d, max(len(y) - 1, 0)), _decoded(rows["tried"].iloc[0])


def arima_model(train: DataFrame, tasks: int | None = None) -> DataFrame:
    """One row a series: chosen orders, constant (of the differenced series), coefficients and innovation variance."""

    def fit(table: pa.Table, cuts: np.ndarray) -> pa.RecordBatch:
        start = cuts[:-1]
        levels = [complete(y) for y in np.split(values(table, "y"), cuts[1:-1])]
        order, tried = values(table, "d")[start], first_of(table, "tried", start).to_pylist()
        d = [min(0 if np.isnan(k) else int(k), max(len(y) - 1, 0)) for k, y in zip(order, levels)]
        found = refined_all([np.diff(y, n=k) for y, k in zip(levels, d)], [[(c["p"], c["q"]) for c in _decoded(t)] for t in tried])
        p, q, beta, s2 = zip(*found)
        lists = pa.list_(pa.float64())
        return pa.RecordBatch.from_arrays(
            [first_of(table, "symbol", start), pa.array(p, pa.int32()), pa.array(d, pa.int32()), pa.array(q, pa.int32()), pa.array([b[0] for b in beta], pa.float64()),
             pa.array([b[1:1 + k] for b, k in zip(beta, p)], lists), pa.array([b[1 + k:] for b, k in zip(beta, p)], lists), pa.array(s2, pa.float64())],
            names=["symbol", "p", "d", "q", "const", "phi", "theta", "sigma2"])

    rows = together(_with_orders(train, tasks), tasks, "y", "d", "tried", order=F.asc_nulls_last("ds"))
    return map_series(rows.select("symbol", "place", "y", "d", "tried"), fit, MODEL)


def forecast_arima(train: DataFrame, periods: int = HORIZON_HOURS, step_seconds: int = 3600, z: float = Z80, tasks: int | None = None) -> DataFrame:
    """Explain-forecast relation (T11): history rows with their value, then ``periods`` forecasts with bands."""

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows, y, d, candidates = _series(rows)
        lower, upper = "prediction_interval_lower_bound", "prediction_interval_upper_bound"
        history = pd.DataFrame({"symbol": rows["symbol"], "time_series_timestamp": rows["ds"], "time_series_data": rows["y"].astype(float)})
        ahead = rows["ds"].iloc[-1] + pd.to_timedelta(np.arange(1, periods + 1) * step_seconds, unit="s")
        if len(y):
            p, q, beta, s2 = _one(y, d, candidates)
            point = forecast_levels(y, d, p, q, beta, periods)
            half = z * np.sqrt(s2 * np.cumsum(psi_weights(beta[1:1 + p], beta[1 + p:], d, periods) ** 2))
        else:
            point = half = np.full(periods, np.nan)
        future = pd.DataFrame({"symbol": rows["symbol"].iloc[0], "time_series_timestamp": ahead, "time_series_data": point, lower: point - half, upper: point + half})
        return pd.concat([history.assign(**{lower: np.nan, upper: np.nan}), future], ignore_index=True).astype({lower: float, upper: float})

    return _with_orders(train, tasks).groupBy("symbol").applyInPandas(fit, EXPLAIN_SCHEMA)
