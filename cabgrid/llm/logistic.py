"""Logistic regression by Newton's method on a bounded dense sample."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * z))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Weights (the first one is the intercept) that minimise the weighted log
    loss plus half of w' penalty w; ``penalty`` covers the intercept too."""
    x = np.concatenate((np.ones((len(x), 1)), x), axis=1)
    w = np.zeros(x.shape[1])

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float(weight @ (np.logaddexp(0, z) - y * z) + 0.5 * v @ penalty @ v)

    best = loss(w)
    for _ in range(rounds):
        p = sigmoid(x @ w)
        slope = x.T @ (weight * (p - y)) + penalty @ w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        size = 1.0
        while (new := loss(w - size * step)) > best and size > 1e-4:
            size /= 2
        if best - new < 1e-9 * max(1.0, abs(best)):
            break
        w, best = w - size * step, new
    return w
