"""Small logistic regression for calibration, on features gathered from a bounded sample."""

from __future__ import annotations

import numpy as np


def fit_logistic(x: np.ndarray, y: np.ndarray, base: float, ridge: float = 1e-2,
                 steps: int = 50) -> np.ndarray:
    """Rows: weights, means, scales.  Rows are weighted so that label 1 has the share ``base``
    (held within 5 and 95 per cent), whatever the shares in the sample."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-12, scale, 1.0)
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    share = min(max(base, 0.05), 0.95)
    weight = np.where(y == 1, share / max(1, (y == 1).sum()), (1 - share) / max(1, (y == 0).sum()))
    w = np.zeros(z.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (weight * (p - y)) + penalty * w
        hessian = (z * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        size = np.abs(step).max()
        w -= step * min(1.0, 4.0 / max(size, 1e-12))
        if size < 1e-8:
            break
    return np.vstack([w, np.append(mean, 0.0), np.append(scale, 1.0)])


def predict(weights: np.ndarray, x: np.ndarray) -> np.ndarray:
    w, mean, scale = weights
    z = (x - mean[:-1]) / scale[:-1]
    return 1 / (1 + np.exp(-np.clip(z @ w[:-1] + w[-1], -30, 30)))
