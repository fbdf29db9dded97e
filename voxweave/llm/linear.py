"""Sparse logistic regression and probability calibration in NumPy, for bounded training samples."""

from __future__ import annotations

import numpy as np


class Rows:
    """Sparse rows: column indices and values, row ``i`` at ``first[i]:first[i + 1]``."""

    def __init__(self, index: np.ndarray, value: np.ndarray, first: np.ndarray, width: int):
        self.index, self.value, self.first, self.width = index, value.astype(np.float32), first, width
        self.of = np.repeat(np.arange(len(first) - 1), np.diff(first))

    def dot(self, weight: np.ndarray) -> np.ndarray:
        return np.bincount(self.of, self.value * weight[self.index], len(self.first) - 1)

    def back(self, residual: np.ndarray) -> np.ndarray:
        return np.bincount(self.index, self.value * residual[self.of].astype(np.float32), self.width)

    def take(self, rows: np.ndarray) -> Rows:
        n = np.diff(self.first)[rows]
        first = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(self.first[:-1][rows] - first[:-1], n) + np.arange(first[-1])
        return Rows(self.index[at], self.value[at], first, self.width)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Adam:
    def __init__(self, shape, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(shape), np.zeros(shape), 0, rate

    def step(self, grad: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m += 0.1 * (grad - self.m)
        self.v += 0.01 * (grad * grad - self.v)
        return self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.99**self.t)) + 1e-10)


def logistic(x: Rows, y: np.ndarray, steps: int = 80, rate: float = 0.1, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias; rows are weighted so that both classes count the same."""
    weight, bias = np.zeros(x.width), 0.0
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    own, base = Adam(x.width, rate), Adam(1, rate)
    for _ in range(steps):
        residual = (sigmoid(x.dot(weight) + bias) - y) * share
        weight -= own.step(x.back(residual) + ridge * weight)
        bias -= float(base.step(np.array([residual.sum()]))[0])
    return weight, bias


def platt(score: np.ndarray, y: np.ndarray, share: np.ndarray, steps: int = 400) -> tuple[float, float]:
    """Slope and offset that turn scores into probabilities, rows weighted by ``share``."""
    n1, n0 = max(1, (y == 1).sum()), max(1, (y == 0).sum())
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))  # Platt's softened targets
    scale = max(1e-9, float(np.std(score)))
    z, share = score / scale, share / max(1e-12, share.sum())
    a, b, step = 1.0, 0.0, Adam(2, 0.05)
    for _ in range(steps):
        residual = (sigmoid(a * z + b) - target) * share
        da, db = step.step(np.array([(residual * z).sum(), residual.sum()]))
        a, b = a - da, b - db
    return a / scale, b
