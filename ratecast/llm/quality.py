"""Quality classifier: naive-Bayes-scaled n-gram indicators and a linear hinge-loss model.

Terms are hashed byte 4-grams and 6-grams of the text's shape (letters and
digits replaced by their class). Each indicator is scaled by the log ratio of
its smoothed share among good and among bad documents; the scaled, unit-length
vectors are separated by a support vector machine fitted by dual coordinate
descent; the weights are drawn towards their mean size, as naive Bayes would
have them. Margins of a two-fold fit calibrate the score.

Defined cases: an empty or null text has no term and gets the score of the
bias alone; without labels of both classes every score is the smoothed share
of label 1; long texts are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from ratecast.llm import labelled
from ratecast.llm.bytes_hash import mix

BITS = 18
#: Byte -> class: a lower-case or non-ASCII letter, A upper case, 0 digit, white space, else itself.
SHAPE = np.array([97 if c >= 128 or 97 <= c <= 122 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57
                  else 32 if c in (9, 11, 12, 13, 32) else c for c in range(256)], np.uint8)


def _ngrams(data: np.ndarray, n: int) -> np.ndarray:
    """A number for every n-gram that starts in ``data``."""
    h = np.zeros(len(data) - n + 1, np.uint64)
    for k in range(n):
        h = h * np.uint64(257) + data[k:len(data) - n + 1 + k]
    return h


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes = []
    for kind, (values, n) in enumerate(((data, 4), (SHAPE[data], 6))):
        if len(values) >= n:
            h = mix(_ngrams(values, n) + np.uint64(kind << 56)) >> np.uint64(64 - BITS)
            hashes.append((n, h.astype(np.int32)))
    seen, found = np.zeros(1 << BITS, bool), []
    for s, e in zip(offsets[:-1], offsets[1:] - 1):  # e: the byte that ends the text
        for n, h in hashes:
            seen[h[s:max(s, e - n + 1)]] = True
        found.append(np.flatnonzero(seen))
        seen[found[-1]] = False
    owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
    return owner, np.concatenate(found) if found else np.empty(0, np.int64)


@dataclass(frozen=True)
class Model:
    """Weights by term (already times the log-count ratio), their bias and the calibration of the margin."""

    weight: np.ndarray
    ratio: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, terms: list[np.ndarray]) -> np.ndarray:
        out = np.full(len(terms), self.bias)
        for i, t in enumerate(terms):
            if t.size:
                out[i] += self.weight[t].sum() / max(np.sqrt(np.square(self.ratio[t]).sum()), 1e-9)
        return out

    def scores(self, terms: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(terms) + self.shift, -30, 30)))


def log_count_ratio(terms: list[np.ndarray], y: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    one, zero = np.full(1 << BITS, alpha), np.full(1 << BITS, alpha)
    for t, label in zip(terms, y):
        (one if label else zero)[t] += 1
    return np.log(one / one.sum()) - np.log(zero / zero.sum())


def dual_coordinate_descent(x: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: np.ndarray,
                            epochs: int = 20, tolerance: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised hinge loss; the bias is a feature of value 1."""
    w, bias = np.zeros(1 << BITS), 0.0
    alpha = np.zeros(len(y))
    sign = np.where(y == 1, 1.0, -1.0)
    square = np.array([np.square(v).sum() + 1 for v in values])
    order, rng = np.arange(len(y)), np.random.default_rng(7)
    for _ in range(epochs):
        rng.shuffle(order)
        worst = 0.0
        for i in order:
            g = sign[i] * (w[x[i]] @ values[i] + bias) - 1
            projected = min(g, 0) if alpha[i] == 0 else max(g, 0) if alpha[i] >= cost[i] else g
            if projected:
                worst = max(worst, abs(projected))
                new = min(max(alpha[i] - g / square[i], 0.0), cost[i])
                step = (new - alpha[i]) * sign[i]
                alpha[i] = new
                w[x[i]] += step * values[i]
                bias += step
        if worst < tolerance:
            break
    return w, bias


def _fit(terms: list[np.ndarray], y: np.ndarray, c: float, beta: float) -> Model:
    r = log_count_ratio(terms, y)
    values = [r[t] / max(np.sqrt(np.square(r[t]).sum()), 1e-9) for t in terms]
    share = y.mean()
    cost = np.where(y == 1, c * 0.5 / share, c * 0.5 / (1 - share))
    w, bias = dual_coordinate_descent(terms, values, y, cost)
    w = (1 - beta) * np.abs(w).mean() + beta * w
    return Model(w * r, r, bias, 1.0, 0.0)


def fit(terms: list[np.ndarray], y: np.ndarray, c: float = 4.0, beta: float = 0.9) -> Model:
    """The model, calibrated on margins that each half of the sample gets from the other half's fit."""
    if len(set(y.tolist())) < 2 or min(np.bincount(y, minlength=2)) < 4:
        zeros = np.zeros(1 << BITS)
        share = (y.sum() + 1) / (len(y) + 2)
        return Model(zeros, zeros, 0.0, 1.0, float(np.log(share / (1 - share))))
    half = np.zeros(len(y), bool)
    for label in (0, 1):
        half[np.flatnonzero(y == label)[::2]] = True
    margins = np.empty(len(y))
    for part in (half, ~half):
        m = _fit([t for t, p in zip(terms, part) if p], y[part], c, beta)
        margins[~part] = m.margins([t for t, p in zip(terms, part) if not p])
    slope, shift = labelled.platt(margins, y)
    m = _fit(terms, y, c, beta)
    return Model(m.weight, m.ratio, m.bias, slope, shift)


def quality(docs: DataFrame, labels: DataFrame, *carry: str, max_docs: int = labelled.MAX_FIT_DOCS, threshold: float = 0.3) -> DataFrame:
    """``doc_id, text, held_out, score`` (likelihood of label 1), ``predicted`` and the carried columns."""
    model = fit(*labelled.fit_sample(docs, labels, "quality", features, max_docs))
    return labelled.scored(docs, features, model.scores, threshold, *carry)
