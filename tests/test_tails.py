import math
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallystone.functions import tails
from tallystone.functions.normality import shapiro_wilk


def test_published_quantiles_and_tails():
    assert tails.t_quantile(0.975, 10) == pytest.approx(2.228139, abs=1e-6)
    assert tails.t_quantile(0.975, 4) == pytest.approx(2.776445, abs=1e-6)
    assert tails.t_quantile(0.975, 1e9) == pytest.approx(1.959964, abs=1e-6)
    assert tails.normal_sf(1.959963984540054) == pytest.approx(0.025, abs=1e-12)
    assert tails.chi2_sf(3.841459, 1) == pytest.approx(0.05, abs=1e-7)
    assert tails.chi2_sf(18.307038, 10) == pytest.approx(0.05, abs=1e-7)
    assert tails.f_sf(4.256495, 2, 9) == pytest.approx(0.05, abs=1e-6)
    # with two numerator degrees of freedom the tail has a closed form
    assert tails.f_sf(270.1, 2, 9) == pytest.approx((1 + 2 * 270.1 / 9) ** -4.5, rel=1e-9)
    assert tails.kolmogorov_sf(1.3581 / math.sqrt(1e10), 1e10) == pytest.approx(0.05, abs=1e-4)


def test_edges():
    assert tails.chi2_sf(0, 3) == 1.0
    assert tails.f_sf(0, 2, 3) == 1.0
    assert tails.t_two_sided(0, 5) == 1.0
    assert tails.chi2_sf(5000, 2) == 0.0
    assert tails.t_two_sided(100, 1e6) == 0.0


def ks_by_counting(d, n1, n2):
    """Share of arrangements whose gap reaches d."""
    hits = total = 0
    for chosen in combinations(range(n1 + n2), n1):
        picked = set(chosen)
        i = j = 0
        worst = 0.0
        for k in range(n1 + n2):
            i, j = (i + 1, j) if k in picked else (i, j + 1)
            worst = max(worst, abs(i / n1 - j / n2))
        hits += worst >= d - 1e-12
        total += 1
    return hits / total


@pytest.mark.parametrize("n1,n2,d", [(4, 5, 0.6), (3, 6, 0.5), (5, 5, 0.8), (2, 7, 1.0), (4, 4, 0.25)])
def test_ks_exact_matches_counting(n1, n2, d):
    assert tails.ks_exact_sf(d, n1, n2) == pytest.approx(ks_by_counting(d, n1, n2), abs=1e-12)


def test_ks_exact_and_series_agree_on_large_samples():
    d, n1, n2 = 0.03, 4000, 5000
    d = round(d * n1 * n2) / (n1 * n2)
    assert tails.ks_exact_sf(d, n1, n2) == pytest.approx(tails.kolmogorov_sf(d, n1 * n2 / (n1 + n2)), abs=2e-3)


@pytest.mark.parametrize("n1,n2", [(3, 4), (5, 2), (4, 4), (1, 6)])
def test_rank_sum_exact_matches_counting(n1, n2):
    us = [sum(c) + n1 - n1 * (n1 + 1) / 2 for c in combinations(range(n1 + n2), n1)]
    for u in sorted(set(us)):
        larger = max(u, n1 * n2 - u)
        want = min(1.0, 2 * sum(x >= larger for x in us) / len(us))
        assert tails.rank_sum_exact_two_sided(u, n1, n2) == pytest.approx(want)


def test_shapiro_wilk_published_example():
    # body weights of eleven men, a classic worked example of the test
    w, p = shapiro_wilk(np.array([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]))
    assert w == pytest.approx(0.79, abs=0.005)
    assert p == pytest.approx(0.0067, abs=0.0005)


def test_shapiro_wilk_tells_normal_from_uniform():
    rng = np.random.default_rng(1)
    assert shapiro_wilk(rng.normal(size=2000))[1] > 0.05
    assert shapiro_wilk(rng.uniform(size=2000))[1] < 1e-10
    assert shapiro_wilk(np.ones(10)) == (1.0, 1.0)
    assert 0 <= shapiro_wilk(np.array([1.0, 2.0, 4.0]))[1] <= 1


def range_by_hand(q, k, df):
    """The tail as plain sums over fine grids."""
    z = np.linspace(-9, 9, 3601)
    cdf = np.array([0.5 * math.erfc(-x / math.sqrt(2)) for x in z])
    density = np.exp(-z * z / 2) / math.sqrt(2 * math.pi)
    s = np.linspace(1e-6, 1 + 14 / math.sqrt(2 * df), 8001)
    weight = np.exp((df - 1) * np.log(s) - df * (s * s - 1) / 2)
    inner = [k * (density * (cdf - np.interp(z - q * t, z, cdf, left=0.0)) ** (k - 1)).sum() * (z[1] - z[0]) for t in s]
    return 1 - float((weight * inner).sum() / weight.sum())


@pytest.mark.parametrize(("q", "k", "df"), [(3.5, 3, 10), (1.0, 4, 3), (4.2, 10, 30), (2.77, 2, 1000), (6.0, 5, 2), (0.2, 3, 50)])
def test_studentized_range_matches_a_plain_integral(q, k, df):
    assert tails.studentized_range_sf(np.array([q]), k, df)[0] == pytest.approx(range_by_hand(q, k, df), abs=2e-6)


def test_studentized_range_known_values():
    # the published 5 per cent points, and with two groups the t test
    for q, k, df in ((3.877, 3, 10), (4.232, 5, 20), (3.314, 3, 1e9), (4.474, 10, 1e9)):
        assert tails.studentized_range_sf(np.array([q]), k, df)[0] == pytest.approx(0.05, abs=2e-4)
    for t, df in ((0.5, 5), (2.1, 17), (3.3, 400)):
        assert tails.studentized_range_sf(np.array([t * math.sqrt(2)]), 2, df)[0] == pytest.approx(tails.t_two_sided(t, df), abs=1e-9)
    assert list(tails.studentized_range_sf(np.array([0.0, 1e9]), 3, 5)) == pytest.approx([1.0, 0.0], abs=1e-10)


@given(st.integers(0, 40), st.integers(0, 40), st.integers(0, 40), st.integers(0, 40))
@settings(max_examples=200, deadline=None)
def test_fisher_matches_all_tables(a, b, c, d):
    rows, cols, n = a + b, a + c, a + b + c + d
    weight = {x: math.comb(cols, x) * math.comb(n - cols, rows - x) for x in range(max(0, rows + cols - n), min(rows, cols) + 1)}
    want = sum(w for w in weight.values() if w <= weight[a] * (1 + 1e-7)) / sum(weight.values())
    assert tails.fisher_two_sided(a, b, c, d) == pytest.approx(want, rel=1e-9)


def test_fisher_at_any_size():
    big = tails.fisher_two_sided(500_300_000, 499_700_000, 499_900_000, 500_100_000)
    z = (0.5003 - 0.4999) / math.sqrt(0.5001 * 0.4999 * 2e-9)
    assert big == pytest.approx(2 * tails.normal_sf(z), rel=0.01, abs=1e-12)
    assert tails.fisher_two_sided(10**9, 0, 0, 10**9) == 0.0
