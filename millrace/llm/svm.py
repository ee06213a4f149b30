"""Linear hinge-loss models by dual coordinate descent, and the calibration of their margins."""

from __future__ import annotations

import numpy as np


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, width: int, cost: float = 1.0, rounds: int = 20, seed: int = 0) -> tuple[np.ndarray, float]:
    """Weights and bias of min |w|^2/2 + sum cost_i * hinge. rows: (indices, values) of each example; y: +1 or -1.

    Both classes get the same total cost. The bias is the weight of a constant feature."""
    w, bias = np.zeros(width), 0.0
    share = {s: cost * len(y) / (2 * max(1, int((y == s).sum()))) for s in (-1, 1)}
    upper = np.array([share[int(s)] for s in y])
    norm = np.array([float(v @ v) + 1 for _, v in rows])
    alpha = np.zeros(len(y))
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(y)):
            index, value = rows[i]
            gradient = y[i] * (float(w[index] @ value) + bias) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), upper[i])
            if (step := (new - alpha[i]) * y[i]) != 0:
                w[index] += step * value
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w, bias


def calibrate(margin: np.ndarray, y: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope (at least 0.1) and shift of a logistic curve from margins to the probability of +1, by Newton's method on smoothed targets."""
    good = int((y > 0).sum())
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (len(y) - good + 2))
    x = np.column_stack([margin, np.ones(len(margin))])
    at = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), x.T @ (p - target) + 1e-3 * at)
        at = at - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return max(0.1, float(at[0])), float(at[1])


def probability(margin: np.ndarray, slope: float, shift: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(slope * margin + shift, -30, 30)))
