"""Fitting small models on sparse rows that have been brought to the driver as a bounded sample."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35.0, 35.0)))


def adam(parameters: list[np.ndarray], gradient: Callable[[], list[np.ndarray]], steps: int, rate: float) -> None:
    """Moves the parameters in place, with a rate that falls to a tenth."""
    first = [np.zeros_like(p) for p in parameters]
    second = [np.zeros_like(p) for p in parameters]
    for t in range(1, steps + 1):
        now = rate * (1 - 0.9 * (t - 1) / steps)
        for p, g, m, v in zip(parameters, gradient(), first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= now * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)


def calibration(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's (a, c): the probability is sigmoid(a * z + c).  Targets are smoothed, a stays positive."""
    if not len(z):
        return 1.0, 0.0
    n1 = float(y.sum())
    n0 = len(y) - n1
    goal = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, c = 1.0, 0.0
    for _ in range(100):
        p = sigmoid(a * z + c)
        d, s = p - goal, np.maximum(p * (1 - p), 1e-9)
        g = np.array([(d * z).sum() + 1e-3 * (a - 1), d.sum()])
        h = np.array([[(s * z * z).sum() + 1e-3, (s * z).sum()], [(s * z).sum(), s.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, c = max(1e-3, a - float(np.clip(step[0], -2, 2))), c - float(np.clip(step[1], -5, 5))
        if np.abs(step).max() < 1e-8:
            break
    return a, c
