"""Small logistic models, fitted on the driver from bounded samples."""

from __future__ import annotations

import numpy as np


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 40) -> np.ndarray:
    """Offset and weights of a ridge logistic regression, by Newton steps."""
    x = np.c_[np.ones(len(x)), x]
    w, ridge = np.zeros(x.shape[1]), penalty * len(y) * np.eye(x.shape[1])
    for _ in range(steps):
        p = logistic(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w
