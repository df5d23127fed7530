"""Multinomial logistic regression trained with follow-the-regularised-leader, and its calibration."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

Row = tuple[np.ndarray, np.ndarray]  # feature numbers and their values


class Ftrl:
    """FTRL-proximal with elastic-net penalties; one weight vector for each class.

    The last feature is the intercept, which is not penalised.
    """

    def __init__(
        self, classes: int, features: int, alpha: float, l1: float, l2: float, beta: float = 1.0
    ) -> None:
        self.z = np.zeros((classes, features + 1))
        self.n = np.zeros((classes, features + 1))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[:, at], self.n[:, at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def _with_intercept(self, row: Row) -> Row:
        return np.append(row[0], self.z.shape[1] - 1), np.append(row[1], 1.0)

    def fit(self, rows: Sequence[Row], labels: Sequence[int], epochs: int) -> None:
        for epoch in range(epochs):
            order = np.random.default_rng(epoch).permutation(len(rows))
            for i in order:
                at, x = self._with_intercept(rows[i])
                w = self.weights(at)
                w[:, -1] = -self.z[:, -1] / ((self.beta + np.sqrt(self.n[:, -1])) / self.alpha)
                p = softmax(w @ x)
                p[labels[i]] -= 1
                gradient = p[:, None] * x
                squares = gradient * gradient
                n = self.n[:, at]
                step = (np.sqrt(n + squares) - np.sqrt(n)) / self.alpha
                self.z[:, at] += gradient - step * w
                self.n[:, at] = n + squares

    def final(self) -> np.ndarray:
        """``(classes, features + 1)``; the last column is the intercept."""
        w = self.weights(slice(None))
        w[:, -1] = -self.z[:, -1] / ((self.beta + np.sqrt(self.n[:, -1])) / self.alpha)
        return w


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max())
    return e / e.sum()


def logits_of(weights: np.ndarray, row: Row) -> np.ndarray:
    return weights[:, row[0]] @ row[1] + weights[:, -1]


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least log loss on rows that were not trained on."""
    if not len(logits):
        return 1.0

    def loss(log_t: float) -> float:
        scaled = logits / np.exp(log_t)
        top = scaled.max(axis=1, keepdims=True)
        total = np.log(np.exp(scaled - top).sum(axis=1)) + top[:, 0]
        return float((total - scaled[np.arange(len(labels)), labels]).mean())

    low, high, ratio = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))
