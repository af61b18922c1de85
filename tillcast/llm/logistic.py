"""Logistic regression for models fitted on a bounded sample on the driver."""

from __future__ import annotations

import numpy as np


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, rounds: int = 300) -> np.ndarray:
    """Weights of dense columns by Newton steps; the penalty keeps separable data finite."""
    w = np.zeros(x.shape[1])
    for _ in range(min(rounds, 60)):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ (p - y) / len(y) + penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x / len(y) + penalty * np.eye(x.shape[1])
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_sparse(
    rows: np.ndarray, cols: np.ndarray, values: np.ndarray, y: np.ndarray, size: int, penalty: float = 1e-4
) -> np.ndarray:
    """Weights of ``size`` hashed columns by accelerated gradient steps; rows sum to at most one in square."""
    w, look, t = np.zeros(size), np.zeros(size), 1.0
    for _ in range(300):
        p = 1 / (1 + np.exp(-np.bincount(rows, values * look[cols], len(y))))
        slope = np.bincount(cols, values * (p - y)[rows], size) / len(y) + penalty * look
        new = look - 4.0 * slope
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        look = new + (before - 1) / t * (new - w)
        w = new
    return w


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
