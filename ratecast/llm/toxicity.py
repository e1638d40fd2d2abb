"""Toxicity: a second-order factorization machine over hashed terms.

Terms are the lower-cased words of a text and their first five letters'
bytes, hashed. Of the terms in the labelled sample the most informative get
weights: one linear weight and a short factor vector each, so that a pair of
terms (an insult and whom it is aimed at) can weigh more or less than its parts.
Fitted by adaptive gradient steps on the logistic loss, class-balanced;
two-fold margins calibrate the score.

Defined cases: an empty or null text has no term and gets the bias's score;
without labels of both classes every score is the smoothed share of label 1;
long texts are read whole; a word counts once however often it occurs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from ratecast.llm import labelled
from ratecast.llm.bytes_hash import Substrings, lowered, runs

BITS = 30
PREFIX = 5
MAX_TERMS = 4096
#: Least log-likelihood ratio of a term that gets weights: below it, chance explains the difference.
MIN_GAIN = 6.0
FACTORS = 8
#: Bytes of a word: ASCII letters and digits, and all of multi-byte characters.
WORD = np.array([c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 for c in range(256)])


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = lowered(data)
    start, end = runs(WORD[low])
    owner = np.searchsorted(offsets, start, "right") - 1
    h = Substrings(low)
    whole = h(start, end) >> np.uint64(64 - BITS)
    cut = np.minimum(end, start + PREFIX)
    first = (h(start, cut) * np.uint64(0xA24BAED4963EE407)) >> np.uint64(64 - BITS)
    long = end - start > PREFIX
    key = np.sort(np.concatenate(((owner << BITS) | whole.astype(np.int64),
                                  (owner[long] << BITS) | first[long].astype(np.int64))))
    key = key[np.concatenate(([True], key[1:] != key[:-1]))] if len(key) else key
    return key >> BITS, key & ((1 << BITS) - 1)


@dataclass(frozen=True)
class Model:
    """Chosen terms (sorted), their weights and factors, the bias and the calibration."""

    terms: np.ndarray
    weight: np.ndarray
    factor: np.ndarray
    bias: float
    slope: float
    shift: float

    def known(self, found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(row, place of the term) of every chosen term of the texts."""
        row = np.repeat(np.arange(len(found)), [len(f) for f in found])
        t = np.concatenate(found) if found else np.empty(0, np.int64)
        if not len(self.terms):
            return row[:0], t[:0].astype(np.int64)
        at = np.minimum(np.searchsorted(self.terms, t), len(self.terms) - 1)
        hit = self.terms[at] == t
        return row[hit], at[hit]

    def margins(self, found: list[np.ndarray]) -> np.ndarray:
        row, at = self.known(found)
        return _margin(row, at, len(found), self.weight, self.factor, self.bias)[0]

    def scores(self, found: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(found) + self.shift, -30, 30)))


def _margin(row, at, n, weight, factor, bias):
    """bias + sum of weights + the pairs' inner products, and each row's factor sum."""
    sums = np.zeros((n, factor.shape[1]))
    np.add.at(sums, row, factor[at])
    linear = np.bincount(row, weight[at], n)
    squares = np.bincount(row, np.square(factor[at]).sum(1), n)
    return bias + linear + 0.5 * (np.square(sums).sum(1) - squares), sums


def choose(found: list[np.ndarray], y: np.ndarray, most: int, least_docs: int = 2) -> np.ndarray:
    """The terms that tell the classes apart best, by the size of their log-likelihood ratio statistic."""
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    names, at = np.unique(np.concatenate(found), return_inverse=True)
    both = np.bincount(at, minlength=len(names))
    one = np.bincount(at, np.repeat(y, [len(f) for f in found]), len(names))
    a, b = one + 0.5, both - one + 0.5
    mean = (a + b) / (n1 + n0 + 2)
    gain = a * np.log(a / ((n1 + 1) * mean)) + b * np.log(b / ((n0 + 1) * mean))
    gain[both < least_docs] = 0
    best = np.argsort(-gain, kind="stable")[:min(most, int((gain >= MIN_GAIN).sum()))]
    return np.sort(names[best])


def _fit(found: list[np.ndarray], y: np.ndarray, factors: int, epochs: int, rate: float, decay: float) -> Model:
    rng = np.random.default_rng(11)
    terms = choose(found, y, MAX_TERMS)
    k = len(terms)
    weight, factor, bias = np.zeros(k), rng.normal(0, 0.05, (k, factors)), 0.0
    m = Model(terms, weight, factor, 0.0, 1.0, 0.0)
    known = [m.known([f])[1] for f in found]
    sizes = np.array([len(a) for a in known])
    gw, gv, gb = np.full(k, 1e-6), np.full((k, factors), 1e-6), 1e-6
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    order = np.arange(len(y))
    for _ in range(epochs):
        rng.shuffle(order)
        for s in range(0, len(order), 64):
            part = order[s:s + 64]
            row, at = np.repeat(np.arange(len(part)), sizes[part]), np.concatenate([known[i] for i in part])
            out, sums = _margin(row, at, len(part), weight, factor, bias)
            g = balance[part] * (1 / (1 + np.exp(-np.clip(out, -30, 30))) - y[part]) / len(part)
            dw = np.bincount(at, g[row], k) + decay * weight
            dv = np.zeros_like(factor)
            np.add.at(dv, at, g[row][:, None] * (sums[row] - factor[at]))
            dv += decay * factor
            gw += dw * dw
            gv += dv * dv
            gb += g.sum() ** 2
            weight -= rate * dw / np.sqrt(gw)
            factor -= rate * 0.3 * dv / np.sqrt(gv)
            bias -= rate * g.sum() / np.sqrt(gb)
    return Model(terms, weight, factor, float(bias), 1.0, 0.0)


def fit(found: list[np.ndarray], y: np.ndarray, factors: int = FACTORS, epochs: int = 8, rate: float = 0.1, decay: float = 1e-4) -> Model:
    """The model, calibrated on margins that each half of the sample gets from the other half's fit."""
    if len(set(y.tolist())) < 2 or min(np.bincount(y, minlength=2)) < 4:
        share = (y.sum() + 1) / (len(y) + 2)
        return Model(np.empty(0, np.int64), np.zeros(0), np.zeros((0, factors)), 0.0, 1.0, float(np.log(share / (1 - share))))
    half = np.zeros(len(y), bool)
    for label in (0, 1):
        half[np.flatnonzero(y == label)[::2]] = True
    margins = np.empty(len(y))
    for part in (half, ~half):
        m = _fit([f for f, p in zip(found, part) if p], y[part], factors, epochs, rate, decay)
        margins[~part] = m.margins([f for f, p in zip(found, part) if not p])
    slope, shift = labelled.platt(np.clip(margins, -20, 20), y)
    m = _fit(found, y, factors, epochs, rate, decay)
    return Model(m.terms, m.weight, m.factor, m.bias, slope, shift)


def toxicity(docs: DataFrame, labels: DataFrame, *carry: str, max_docs: int = labelled.MAX_FIT_DOCS, threshold: float = 0.5) -> DataFrame:
    """``doc_id, text, held_out, score`` (likelihood of label 1), ``predicted`` and the carried columns."""
    model = fit(*labelled.fit_sample(docs, labels, "toxic", features, max_docs))
    return labelled.scored(docs, features, model.scores, threshold, *carry)
