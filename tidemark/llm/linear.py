"""A linear scorer over hashed features, fitted on a bounded table of examples."""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np


def hashed(name: str, size: int) -> int:
    """The place of a feature; the same in every process."""
    return zlib.crc32(name.encode("utf-8", "replace")) % size


def sigmoid(x: np.ndarray | float) -> np.ndarray | float:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def score(weights: np.ndarray, places: Iterable[int], values: Iterable[float]) -> float:
    """Probability of the positive class; the last weight is the bias."""
    at = np.fromiter(places, np.int64)
    return float(sigmoid(weights[-1] + weights[at] @ np.fromiter(values, np.float64)))


def fit(
    places: list[list[int]],
    values: list[list[float]],
    targets: np.ndarray,
    size: int,
    weights: np.ndarray | None = None,
    ridge: float = 1.0,
    rounds: int = 300,
) -> np.ndarray:
    """Logistic regression on sparse rows with soft targets, by accelerated gradient steps.

    Deterministic; the step follows from the largest row norm. Returns ``size`` weights and a bias. With no
    rows all weights are 0.
    """
    found = np.zeros(size + 1)
    n = len(places)
    if not n:
        return found
    lengths = np.array([len(p) + 1 for p in places])
    at = np.concatenate([np.array([*p, size], np.int64) for p in places])
    value = np.concatenate([np.array([*v, 1.0]) for v in values])
    row = np.repeat(np.arange(n), lengths)
    weight = np.ones(n) if weights is None else weights
    norm = np.bincount(row, value**2, n).max()
    step = 1.0 / (0.25 * norm * weight.sum() + ridge)
    # The usual bound is loose: examples spread over many features, so larger steps are tried and taken back.
    ahead, before, pace = found.copy(), found.copy(), 16.0

    def loss(w: np.ndarray) -> float:
        margin = np.bincount(row, w[at] * value, n)
        fits = np.logaddexp(0, margin) - targets * margin
        return float(weight @ fits + 0.5 * ridge * (w[:-1] @ w[:-1]))

    last = loss(found)
    for i in range(rounds):
        margin = np.bincount(row, ahead[at] * value, n)
        error = weight * (sigmoid(margin) - targets)
        slope = np.bincount(at, error[row] * value, size + 1)
        slope[:-1] += ridge * ahead[:-1]
        new = ahead - pace * step * slope
        now = loss(new)
        if now > last:
            pace, ahead, before = max(pace / 2, 0.5), found.copy(), found.copy()
            continue
        before, found, last = found, new, now
        ahead = found + i / (i + 3) * (found - before)
    return found
