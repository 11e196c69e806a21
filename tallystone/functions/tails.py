"""Tail probabilities for the finishing step of the tests.

They run on result rows only (one per tested column), never on data rows.
"""

from __future__ import annotations

import math

import numpy as np


def normal_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def _beta_fraction(a: float, b: float, x: float) -> float:
    # modified Lentz evaluation of the continued fraction of the incomplete beta function
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 100_000):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            c = 1.0 + num / c
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def gamma_sf(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0.0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1.0
            term *= x / k
            total += term
        return 1.0 - front * total
    tiny = 1e-300
    b = x + 1.0 - a
    c, d = 1.0 / tiny, 1.0 / b
    h = d
    for i in range(1, 100_000):
        num = -i * (i - a)
        b += 2.0
        d = num * d + b
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = b + num / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return front * h


def t_two_sided(t: float, df: float) -> float:
    return 1.0 if t == 0 else beta_inc(df / 2.0, 0.5, df / (df + t * t))


def t_quantile(p: float, df: float) -> float:
    """Upper quantile of Student's t for p > 0.5, by bisection on the two-sided tail."""
    target = 2.0 * (1.0 - p)
    low, high = 0.0, 1.0
    while t_two_sided(high, df) > target:
        high *= 2.0
    for _ in range(200):
        mid = 0.5 * (low + high)
        if t_two_sided(mid, df) > target:
            low = mid
        else:
            high = mid
    return 0.5 * (low + high)


def f_sf(f: float, d1: float, d2: float) -> float:
    return 1.0 if f <= 0 else beta_inc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def chi2_sf(x: float, df: float) -> float:
    return gamma_sf(df / 2.0, x / 2.0)


def kolmogorov_sf(d: float, n: float) -> float:
    """Two-sided Kolmogorov tail for statistic ``d`` at effective size ``n``.

    The limit series is evaluated at a size-corrected argument, which removes
    the error terms of order 1/sqrt(n) and 1/n.
    """
    z = d * math.sqrt(n)
    x = z + 1.0 / (6.0 * math.sqrt(n)) + (z - 1.0) / (4.0 * n)
    if x < 0.2:
        return 1.0
    total = sum((-1) ** (k - 1) * math.exp(-2.0 * k * k * x * x) for k in range(1, 101))
    return min(1.0, max(0.0, 2.0 * total))


def ks_exact_sf(d: float, n1: int, n2: int) -> float:
    """Exact two-sample tail: chance that a random lattice path leaves the band |i/n1 - j/n2| < d."""
    gap = round(d * n1 * n2)  # the statistic is a multiple of 1/(n1*n2)
    if gap == 0:
        return 1.0
    inside = np.zeros(n1 + 1)
    inside[0] = 1.0
    i = np.arange(n1 + 1, dtype=np.float64)
    for step in range(1, n1 + n2 + 1):
        # path at (i, step-i); the previous point was (i-1, .) or (i, .)
        take_first = np.empty_like(inside)
        take_first[0] = 0.0
        take_first[1:] = inside[:-1] * np.clip((n1 - i[:-1]) / (n1 + n2 - step + 1), 0.0, 1.0)
        stay = inside * np.clip((n2 - (step - 1 - i)) / (n1 + n2 - step + 1), 0.0, 1.0)
        inside = take_first + stay
        j = step - i
        inside[(j < 0) | (j > n2) | (np.abs(i * n2 - j * n1) >= gap - 0.5)] = 0.0
    # the last point is always inside the band, so its mass is the chance of never leaving
    return float(min(1.0, max(0.0, 1.0 - inside[n1])))


def rank_sum_exact_two_sided(u: float, n1: int, n2: int) -> float:
    """Exact two-sided p of the rank-sum statistic without ties."""
    counts = np.zeros(n1 * n2 + 1)
    counts[0] = 1.0
    total = 1.0
    for i in range(1, n1 + 1):
        # Gaussian binomial: multiply by (1 - q^(n2+i)), divide by (1 - q^i)
        if n2 + i < len(counts):
            counts[n2 + i :] -= counts[: len(counts) - n2 - i].copy()
        for start in range(i):
            counts[start::i] = np.cumsum(counts[start::i])
        total *= (n2 + i) / i
    k = int(max(u, n1 * n2 - u))
    return float(min(1.0, 2.0 * counts[k:].sum() / total))


_STEP, _EDGE = 0.01, 9.0
_GRID = np.arange(-_EDGE, _EDGE + _STEP, _STEP)
_CDF = np.array([0.5 * math.erfc(-x / math.sqrt(2.0)) for x in _GRID])
_DENSITY = np.exp(-0.5 * _GRID * _GRID) / math.sqrt(2.0 * math.pi)


def normal_cdf(x: np.ndarray) -> np.ndarray:
    """Of many arguments at once: cubic pieces through the values and slopes of a fine grid, good to 1e-10."""
    at = np.clip((x + _EDGE) / _STEP, 0, len(_GRID) - 1.000001)
    i = at.astype(np.int64)
    t = at - i
    rise = _CDF[i + 1] - _CDF[i]
    left, right = _DENSITY[i] * _STEP, _DENSITY[i + 1] * _STEP
    return _CDF[i] + t * (left + t * (3 * rise - 2 * left - right + t * (left + right - 2 * rise)))


def studentized_range_sf(q: np.ndarray, groups: int, df: float) -> np.ndarray:
    """Chance that the range of ``groups`` standard normals exceeds ``q`` times an independent root mean square of ``df`` freedoms.

    The inner integral runs over the largest of the normals, the outer one over the root mean square, both by Gauss-Legendre nodes.
    """
    z, z_weight = np.polynomial.legendre.leggauss(200)
    z, z_weight = z * 8.5, z_weight * 8.5
    share = groups * np.exp(-0.5 * z * z) / math.sqrt(2.0 * math.pi) * z_weight
    below = normal_cdf(z)
    spread = 12.0 / math.sqrt(2.0 * df)
    low, high = max(0.0, 1.0 - spread), 1.0 + spread
    s, s_weight = np.polynomial.legendre.leggauss(96)
    s = low + (s + 1.0) / 2.0 * (high - low)
    s_weight = s_weight * np.exp((df - 1.0) * np.log(s) - df * (s * s - 1.0) / 2.0)
    s_weight /= s_weight.sum()  # the density up to a factor
    out = np.empty(len(q))
    for i, one in enumerate(np.asarray(q, float)):
        if not one > 0:
            out[i] = math.nan if math.isnan(one) else 1.0
            continue
        inside = np.clip(below[None, :] - normal_cdf(z[None, :] - (one * s)[:, None]), 0.0, 1.0)
        out[i] = 1.0 - float(s_weight @ (inside ** (groups - 1) @ share))
    return np.clip(out, 0.0, 1.0)


def fisher_two_sided(a: int, b: int, c: int, d: int) -> float:
    """Exact two-sided p of a 2x2 table: the share of tables with its margins that are no likelier than it.

    Weights are walked outwards from the likeliest table by the ratio of neighbours, as logarithms, until they no longer count; so no
    factorial is formed, and the work grows with the spread of the distribution, not with the margins.
    """
    rows, cols, n = a + b, a + c, a + b + c + d
    low, high = max(0, rows + cols - n), min(rows, cols)
    peak = min(high, max(low, (rows + 1) * (cols + 1) // (n + 2)))
    weights, own = [np.zeros(1)], 0.0 if a == peak else -math.inf
    for sign, last in ((1, high), (-1, low)):
        at, log_weight = peak, 0.0
        while at != last and log_weight > -745.0:
            x = np.arange(at, at + sign * min(1_000_000, abs(last - at)), sign, dtype=float)
            if sign > 0:
                step = (rows - x) * (cols - x) / ((x + 1.0) * (n - rows - cols + x + 1.0))
            else:
                step = x * (n - rows - cols + x) / ((rows - x + 1.0) * (cols - x + 1.0))
            logs = log_weight + np.cumsum(np.log(step))
            k = (a - at) * sign
            if 1 <= k <= len(logs):
                own = float(logs[k - 1])
            weights.append(logs)
            at, log_weight = at + sign * len(logs), float(logs[-1])
    logs = np.concatenate(weights)
    w = np.exp(logs)
    return float(min(1.0, w[logs <= own + 1e-7].sum() / w.sum()))
