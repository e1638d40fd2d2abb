"""The sums and fits of the automatic ARIMA for blocks of series, as array operations over all of them at once.

Arrays are ``time x series`` (``series_blocks.columns``); coefficients are ``term x series``.
"""

from __future__ import annotations

import numpy as np

from ratecast.operators.series_blocks import dot, gram, inside, lag, solve

#: Rows that a recursion follows one by one.
STRETCH = 24
#: Shares of a step that are tried, in this order.
SCALES = [[0.5 ** k for k in some] for some in (range(1), range(1, 4), range(4, 10))]
#: Least sum of squares of a fit, as a share of the series' own, that is more than rounding.
EXACT = 1e-16


def kpss_values(x: np.ndarray, n: np.ndarray, lags: int, tiny: float) -> np.ndarray:
    """KPSS level statistics of the series ``x`` with an AR(1)-prewhitened long-run variance of ``lags`` lags at most."""
    far, here = lags + 1, inside(n, len(x))
    c, t = np.cumsum(x, 0) * here, np.arange(1, len(x) + 1)[:, None] * here
    count = np.maximum(n, 1).astype(float)
    mean = x.sum(0) / count
    gamma = np.stack([dot(x, lag(x, k)) / count - mean * mean for k in range(far + 1)])
    top = 1 - 2 / np.sqrt(count)
    with np.errstate(divide="ignore", invalid="ignore"):
        rho = np.maximum(np.minimum(np.where(gamma[0] > 0, gamma[1] / gamma[0], 0.0), top), -top)
        white = [(1 + rho * rho) * gamma[k] - rho * (gamma[k + 1] + gamma[abs(k - 1)]) for k in range(far)]
        width = np.minimum(np.floor(4 * (count / 100) ** 0.25), lags)
        long_run = white[0] + sum(2 * np.maximum(1 - k / (width + 1), 0.0) * white[k] for k in range(1, far))
        long_run = np.maximum(long_run, 1e-3 * white[0]) / ((1 - rho) * (1 - rho))
        squares = dot(c, c) - 2 * mean * dot(t, c) + mean * mean * dot(t, t)
        value = squares / (count * count * long_run)
    return np.where((gamma[0] > tiny) & (long_run > 0) & (n > 3), value, 0.0)


def regressors(w: np.ndarray, n: np.ndarray, lags: int, skip: int) -> list[np.ndarray]:
    """A constant and ``lags`` lags of the series, zeros in the first ``skip`` rows and below its end."""
    here = inside(n, len(w))
    here[:skip] = 0.0
    return [here, *[lag(w, k) * here for k in range(1, lags + 1)]]


def least_squares(x: list[np.ndarray], y: np.ndarray, ridge: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """(coefficients of ``y`` on ``x``, whether the system is far from singular); ``ridge``: on the diagonal, in proportion to it and itself."""
    a, b = gram(x), np.stack([dot(c, y) for c in x])
    for i in range(len(x)):
        a[i, i] += ridge * a[i, i] + ridge
    s, sound = solve(a, b)
    if ridge:
        for k in np.flatnonzero(~sound):
            s[:, k] = np.linalg.lstsq(a[:, :, k], b[:, k], rcond=None)[0]
    return s, sound


def residuals(x: list[np.ndarray], y: np.ndarray, a: np.ndarray) -> np.ndarray:
    """What the terms leave of ``y`` in the rows where the constant is 1, zero elsewhere."""
    return y * x[0] - sum(a[i] * c for i, c in enumerate(x))


def arma_columns(w: np.ndarray, e: np.ndarray, n: np.ndarray, order: int, skip: int) -> list[np.ndarray]:
    """A constant and ``order`` lags of the series and of its innovations."""
    x = regressors(w, n, order, skip)
    return x + [lag(e, k) * x[0] for k in range(1, order + 1)]


def rooted_outside(coef: np.ndarray) -> np.ndarray:
    """``arima._rooted_outside`` of each column."""
    a = coef * 1.001 ** np.arange(1, len(coef) + 1)[:, None]
    good = np.ones(coef.shape[1], bool)
    while len(a):
        k = a[-1]
        good &= np.abs(k) < 1
        k = np.where(good, k, 0.0)
        a = (a[:-1] - k * a[-2::-1]) / (1 - k * k)
    return good


def _recursion(x: np.ndarray, theta: np.ndarray) -> None:
    """Each row less theta_1 of the one before, theta_2 of the one before that, ..., in place."""
    rows: list[np.ndarray] = []
    part = np.empty(np.broadcast_shapes(x.shape[1:], theta.shape[1:]))
    for row in x:
        for c, past in zip(theta, reversed(rows[-len(theta):])):
            np.multiply(c, past, out=part)
            np.subtract(row, part, out=row)
        rows.append(row)


def filtered(x: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """``x`` (time x columns x series) divided by 1 + theta_1 B + ...

    All stretches of STRETCH rows are followed at once as if nothing came before them, then what each hands on to the next is
    followed, and added: a row by itself is too little for an array operation.
    """
    (n, m, b), q = x.shape, len(theta)
    if not q or not x.size:
        return x
    k = -(-n // STRETCH)
    out = np.zeros((k * STRETCH, m, b))
    out[:n] = x
    out = out.reshape(k, STRETCH, m, b)
    _recursion(out.swapaxes(0, 1), theta)
    # reply[l, j]: row l of a stretch for a 1 in the row j + 1 before it
    reply = np.zeros((q + STRETCH, q, b))
    for j in range(q):
        reply[q - 1 - j, j] = 1.0
    for t in range(q, q + STRETCH):
        for i in range(q):
            reply[t] -= theta[i] * reply[t - 1 - i]
    reply = reply[q:]
    hand, ends = reply[:-q - 1:-1], out[:, :-q - 1:-1].copy()  # the last rows of a stretch, the last one first
    for i in range(1, k):
        for j in range(q):
            ends[i] += hand[:, j, None] * ends[i - 1, j]
    for j in range(q):
        out[1:] += reply[:, j, None] * ends[:-1, j, None]
    return out.reshape(k * STRETCH, m, b)[:n]


def css(w: np.ndarray, n: np.ndarray, p: int, q: int, start: np.ndarray, skip: int, steps: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``arima.css`` of each column of series whose mean is 0: (constant, phi, theta), sums of squares, and which fits are sound."""
    here = inside(n, len(w))
    whole = bool(here.all())
    beta = np.where(rooted_outside(-start[1:1 + p]) & rooted_outside(start[1 + p:]), start, 0.0)

    def shifted(at: np.ndarray) -> list[np.ndarray]:
        x = w[:, at]
        return [x, *[lag(x, i) for i in range(1, p + 1)]]

    def innovations(b: np.ndarray, x: list[np.ndarray], at: np.ndarray) -> np.ndarray:
        u = x[0] - b[0]
        for i in range(1, p + 1):
            u -= b[i] * x[i]
        u[:p] = 0.0
        if not whole:
            u *= here[:, at]
        e = filtered(u[:, None], b[1 + p:])[:, 0]
        return e if whole or not q else e * here[:, at]

    def squares(e: np.ndarray) -> np.ndarray:
        return dot(e[skip:], e[skip:])

    live = np.arange(w.shape[1])
    sound = np.ones(len(live), bool)
    e = innovations(beta, shifted(live), live)
    sse = squares(e)
    for _ in range(steps):
        if not len(live):
            break
        x, past = shifted(live), e[:, live]
        g = np.empty((len(w), 1 + p + (q > 0), len(live)))
        g[:, 0] = 1.0
        for i in range(1, p + 1):
            g[:, i] = x[i]
        g[:p] = 0.0
        if q:
            g[:, 1 + p] = past  # its first rows count
        g = filtered(g, beta[1 + p:, live])
        terms = [g[:, i] for i in range(1 + p)] + [lag(g[:, 1 + p], j) for j in range(1, q + 1)]
        terms = [t[skip:] if whole else t[skip:] * here[skip:, live] for t in terms]
        right = np.stack([dot(t, past[skip:]) for t in terms])
        step, good = solve(gram(terms), right)
        sound[live[~good]] = False
        promised = (step * right).sum(0)
        gain = np.full(len(live), -1.0)
        left = np.flatnonzero(good)
        for scales in SCALES:
            # those of a row at once, the largest that is better counts
            tried, scale = np.tile(left, len(scales)), np.repeat(scales, len(left))
            new = beta[:, live[tried]] + scale * step[:, tried]
            able = np.flatnonzero(rooted_outside(-new[1:1 + p]) & rooted_outside(new[1 + p:]))
            if len(able):
                tried, new = tried[able], new[:, able]
                e2 = innovations(new, [c[:, tried] for c in x], live[tried])
                sse2 = squares(e2)
                better = np.flatnonzero(sse2 < sse[live[tried]])
                done, first = np.unique(tried[better], return_index=True)
                best, at = better[first], live[done]
                gain[done] = sse[at] - sse2[best]
                beta[:, at], sse[at], e[:, at] = new[:, best], sse2[best], e2[:, best]
            # a step that promises no more than rounding is not halved
            left = left[(gain[left] < 0) & (promised[left] > 1e-14 * sse[live[left]])]
            if not len(left):
                break
        live = live[(gain >= 0) & (gain >= 1e-6 * sse[live])]
    return beta, sse, sound & (sse > EXACT * dot(w, w))
