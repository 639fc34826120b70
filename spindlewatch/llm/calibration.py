"""Isotonic regression, for turning raw scores into probabilities."""

from __future__ import annotations

import numpy as np


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots (x, fitted y) of the non-decreasing step function with the least weighted squares."""
    order = np.argsort(x, kind="stable")
    levels: list[list[float]] = []  # mean, weight, first x, last x
    for i in order:
        levels.append([float(y[i]), float(weight[i]), float(x[i]), float(x[i])])
        while len(levels) > 1 and (levels[-2][0] >= levels[-1][0] or levels[-2][3] == levels[-1][2]):
            mean, mass, _, last = levels.pop()
            own = levels[-1]
            own[0] = (own[0] * own[1] + mean * mass) / (own[1] + mass)
            own[1] += mass
            own[3] = last
    knots = [(level[at], level[0]) for level in levels for at in (2, 3)]
    return np.array([k[0] for k in knots]), np.clip([k[1] for k in knots], 0, 1)


def calibrated(raw: np.ndarray, knots: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return np.interp(raw, *knots)
