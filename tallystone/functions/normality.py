"""Normality check of a bounded sample: Royston's 1995 approximation (AS R94)."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np

from tallystone.functions.tails import normal_sf

# fixed values: the polynomial coefficients published with the algorithm
WEIGHT_LAST = [0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056]
WEIGHT_SECOND = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
SMALL_GAMMA = [-2.273, 0.459]
SMALL_MEAN = [0.5440, -0.39978, 0.025054, -6.714e-4]
SMALL_LOG_SD = [1.3822, -0.77857, 0.062767, -0.0020322]
LARGE_MEAN = [-1.5861, -0.31082, -0.083751, 0.0038915]
LARGE_LOG_SD = [-0.4803, -0.082676, 0.0030302]


def _poly(coefficients: list[float], x: float) -> float:
    return float(np.polynomial.polynomial.polyval(x, coefficients))


def shapiro_wilk(values: np.ndarray) -> tuple[float, float]:
    """W and its p-value for 3 to 5000 values; a constant sample gives ``(1, 1)``."""
    x = np.sort(np.asarray(values, dtype=float))
    n = len(x)
    spread = float(np.sum((x - x.mean()) ** 2))
    if n < 3 or x[-1] == x[0] or spread == 0.0:
        return 1.0, 1.0
    if n == 3:
        a = np.array([-math.sqrt(0.5), 0.0, math.sqrt(0.5)])
    else:
        inverse = NormalDist().inv_cdf
        m = np.array([inverse((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
        norm = float(m @ m)
        u = 1.0 / math.sqrt(n)
        a = np.empty(n)
        edge = 2 if n > 5 else 1
        ends = [m[-1] / math.sqrt(norm) + _poly(WEIGHT_LAST, u)]
        if edge == 2:
            ends.append(m[-2] / math.sqrt(norm) + _poly(WEIGHT_SECOND, u))
        used = 2.0 * sum(m[-1 - i] ** 2 for i in range(edge))
        phi = (norm - used) / (1.0 - 2.0 * sum(e * e for e in ends))
        a[:] = m / math.sqrt(phi)
        for i, e in enumerate(ends):
            a[-1 - i], a[i] = e, -e
    w = min(1.0, float(a @ x) ** 2 / spread)
    if n == 3:
        p = 6.0 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75)))
        return w, min(1.0, max(0.0, p))
    if w == 1.0:
        return w, 1.0
    y = math.log1p(-w)
    if n <= 11:
        gamma = _poly(SMALL_GAMMA, n)
        if y >= gamma:
            return w, 0.0
        y = -math.log(gamma - y)
        mean, sd = _poly(SMALL_MEAN, n), math.exp(_poly(SMALL_LOG_SD, n))
    else:
        logn = math.log(n)
        mean, sd = _poly(LARGE_MEAN, logn), math.exp(_poly(LARGE_LOG_SD, logn))
    return w, normal_sf((y - mean) / sd)
