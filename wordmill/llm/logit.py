"""Sparse multinomial logistic regression on a bounded sample, and its calibration."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def minimise(value_and_slope: Callable, start: np.ndarray, rounds: int = 60, memory: int = 8, tolerance: float = 1e-6) -> np.ndarray:
    """L-BFGS with backtracking; the same inputs give the same result on every run."""
    x, (f, g) = start, value_and_slope(start)
    steps, turns = [], []
    for _ in range(rounds):
        if np.abs(g).max(initial=0) < tolerance:
            break
        d, used = -g, []
        for s, t in zip(reversed(steps), reversed(turns)):
            a = (s @ d) / (s @ t)
            d = d - a * t
            used.append(a)
        if steps:
            d = d * ((steps[-1] @ turns[-1]) / (turns[-1] @ turns[-1]))
        for s, t, a in zip(steps, turns, reversed(used)):
            d = d + (a - (t @ d) / (s @ t)) * s
        slope, rate = g @ d, 1.0 if steps else min(1.0, 1 / max(np.abs(g).sum(), 1e-12))
        while True:
            new, (f_new, g_new) = x + rate * d, value_and_slope(x + rate * d)
            if f_new <= f + 1e-4 * rate * slope or rate < 1e-10:
                break
            rate /= 2
        if (new - x) @ (g_new - g) > 1e-12:
            steps, turns = [*steps, new - x][-memory:], [*turns, g_new - g][-memory:]
        done = abs(f - f_new) < 1e-9 * max(1.0, abs(f))
        x, f, g = new, f_new, g_new
        if done:
            break
    return x


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Rows:
    """Rows of 0/1 features in both directions, so that products with weights and with residuals are segment sums."""

    def __init__(self, rows: list[np.ndarray], features: int):
        size = np.array([len(r) for r in rows], np.int64)
        self.n, self.features = len(rows), features
        self.flat = np.concatenate(rows).astype(np.int32) if size.sum() else np.empty(0, np.int32)
        self.filled = np.flatnonzero(size)
        self.start = (np.cumsum(size) - size)[self.filled]
        by_feature = np.argsort(self.flat, kind="stable")
        self.owner = np.repeat(np.arange(len(rows), dtype=np.int32), size)[by_feature]
        self.used, self.begin = np.unique(self.flat[by_feature], return_index=True)

    def times(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n)
        if len(self.flat):
            out[self.filled] = np.add.reduceat(weights[self.flat], self.start)
        return out

    def gather(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(self.features)
        if len(self.flat):
            out[self.used] = np.add.reduceat(values[self.owner], self.begin)
        return out


# Rows that are scored at a time: what a task holds does not depend on the rows of an Arrow batch.
SCORED_ROWS = 512


def scores_of(rows: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """Class scores of rows of feature numbers; the last row of ``weights`` is the intercept."""
    out = np.empty((len(rows), weights.shape[1]))
    for i in range(0, len(rows), SCORED_ROWS):
        x = Rows(rows[i:i + SCORED_ROWS], len(weights) - 1)
        out[i:i + SCORED_ROWS] = np.column_stack([x.times(w) + w[-1] for w in weights.T])
    return out


def fit_softmax(rows: list[np.ndarray], labels: np.ndarray, features: int, classes: int, l2: float = 1.0,
                start: np.ndarray | None = None) -> np.ndarray:
    """Weights ``(features + 1, classes)`` of an L2-regularised softmax regression on 0/1 features; class 0 has weights 0."""
    x, n = Rows(rows, features), len(rows)
    truth = np.zeros((n, classes))
    truth[np.arange(n), labels] = 1

    def value_and_slope(w):
        w = w.reshape(classes - 1, features + 1)
        p = softmax(np.column_stack([np.zeros(n), *(x.times(c) + c[-1] for c in w)]))
        gap = (p - truth).T[1:]
        slope = np.array([np.r_[x.gather(g) + l2 * c[:-1], g.sum()] for g, c in zip(gap, w)])
        loss = -np.log(np.maximum((p * truth).sum(axis=1), 1e-300)).sum() + l2 / 2 * (w[:, :-1] ** 2).sum()
        return loss, slope.ravel()

    begin = np.zeros((classes - 1, features + 1)) if start is None else start.T[1:]
    found = minimise(value_and_slope, begin.ravel()).reshape(classes - 1, features + 1)
    return np.column_stack([np.zeros(features + 1), *found])


def fit_line(x: np.ndarray, labels: np.ndarray, l2: float = 1e-3) -> np.ndarray:
    """Binary logistic regression on a few dense columns (Platt scaling, or the combination of views): slopes, then intercept."""
    x = np.column_stack([x, np.ones(len(labels))])

    def value_and_slope(w):
        z = x @ w
        return (np.logaddexp(0, z) - labels * z).sum() + l2 / 2 * (w @ w), x.T @ (1 / (1 + np.exp(-z)) - labels) + l2 * w

    return minimise(value_and_slope, np.zeros(x.shape[1]))


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature, from a fixed grid, that makes held-out softmax probabilities most likely."""
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 41))
    loss = [-np.log(np.maximum(softmax(scores / t)[np.arange(len(labels)), labels], 1e-300)).sum() for t in grid]
    return float(grid[int(np.argmin(loss))]) if len(labels) else 1.0
