"""Probability tails against published tables and exact values."""

import numpy as np
import pytest

from assayspark.functions import tails


def test_f_tail_closed_form():
    found = tails.f_sf(np.array([13.0, 4.0]), np.array([2.0, 2.0]), np.array([6.0, 10.0]))
    assert found == pytest.approx([(6 / 32) ** 3, (10 / 18) ** 5], rel=1e-10)


@pytest.mark.parametrize(("q", "k", "df"), [(3.877, 3, 10), (4.327, 4, 10), (3.958, 4, 20), (2.772, 2, 1e7)])
def test_studentized_range_five_percent_points(q, k, df):
    assert tails.ptukey_sf([q], [k], [df])[0] == pytest.approx(0.05, abs=2e-4)


def test_studentized_range_quantile():
    assert tails.qtukey(np.array([0.95]), np.array([3.0]), np.array([10.0]))[0] == pytest.approx(3.877, abs=1e-3)


def test_studentized_range_of_two_is_t():
    t, df = np.array([2.3]), np.array([7.0])
    assert tails.ptukey_sf(t * np.sqrt(2), [2], df) == pytest.approx(2 * tails.t_sf(t, df), rel=1e-8)


@pytest.mark.parametrize("df", [1e4, 1e6, 1e9, 1e11, 1e12, 1e13, 1e14])
def test_tails_at_large_df_approach_their_limits(df):
    normal, chi4 = tails.normal_sf(np.array([1.5]))[0], np.exp(-4.0) * 5
    near = max(1e-8, 2 / df)
    assert tails.t_sf(np.array([1.5]), np.array([df]))[0] == pytest.approx(normal, abs=near)
    assert 2 * tails.t_sf(np.array([1.5]), np.array([df]))[0] == pytest.approx(
        tails.f_sf(np.array([2.25]), np.array([1.0]), np.array([df]))[0], rel=1e-12)
    assert tails.f_sf(np.array([2.0]), np.array([4.0]), np.array([df]))[0] == pytest.approx(chi4, abs=near)
    assert tails.f_sf(np.array([1.0]), np.array([df]), np.array([df]))[0] == pytest.approx(0.5, abs=1e-8)
    limit = tails.range_upper(np.array([3.3]), 3.0)[0]
    assert tails.ptukey_sf([3.3], [3], [df])[0] == pytest.approx(limit, abs=max(1e-8, 1 / df))


def test_small_tails_keep_their_magnitude():
    t = np.array([9.5, 38.0])
    assert tails.t_sf(t, np.full(2, 1e13)) == pytest.approx(tails.normal_sf(t), rel=1e-6)
    assert tails.t_sf(np.array([1e8, -1e8]), np.ones(2)) == pytest.approx([1e-8 / np.pi, 1 - 1e-8 / np.pi], rel=1e-10)
    assert tails.f_sf(np.array([200.0]), np.array([2.0]), np.array([60.0]))[0] == pytest.approx((60 / 460) ** 30, rel=1e-10)
    far = tails.ptukey_sf([20.0, 40.0], [3, 3], [10, 10])
    assert far[0] > 100 * far[1] > 0
    for t, df in ((2.3, 7.0), (12.0, 50.0), (40.0, 3.0), (20.0, 1e6)):
        two = tails.ptukey_sf([t * 2 ** 0.5], [2], [df])
        assert two == pytest.approx(2 * tails.t_sf(np.array([t]), np.array([df])), rel=1e-6)


def test_tails_at_the_ends():
    assert tails.f_sf(np.array([0.0, np.inf]), np.array([3.0, 3.0]), np.array([5.0, 5.0])).tolist() == [1.0, 0.0]
    assert tails.t_sf(np.array([0.0, np.inf, -np.inf]), np.array([4.0] * 3)) == pytest.approx([0.5, 0.0, 1.0])
    assert tails.ptukey_sf([0.0, 1e300], [4, 4], [9, 9]).tolist() == [1.0, 0.0]


def test_error_function_and_beta_symmetry():
    import math

    x = np.concatenate([np.linspace(-6, 26, 999), [0.46875, 4.0, -40.0, 60.0]])
    assert tails._erfc(x) == pytest.approx([math.erfc(v) for v in x], rel=1e-12)
    a, b, y = np.array([0.5, 3.0, 700.0, 2e5]), np.array([8.0, 0.5, 650.0, 1e7]), np.array([0.3, 0.9, 0.5, 0.98])
    assert tails.beta_upper(a, b, 1 - y, y) + tails.beta_upper(b, a, y, 1 - y) == pytest.approx(np.ones(4), rel=1e-12)
    # I_x(a, b) for whole b is a finite binomial sum.
    p, n, k = 0.37, 40, 17
    exact = sum(math.comb(n, j) * p ** j * (1 - p) ** (n - j) for j in range(k, n + 1))
    assert 1 - tails.beta_upper([k], [n - k + 1], [p], [1 - p])[0] == pytest.approx(exact, rel=1e-12)


@pytest.mark.parametrize(("k", "df"), [(2, 1.0), (3, 10.0), (5, 2400.0), (10, 1e9)])
def test_studentized_range_quantile_inverts_the_tail(k, df):
    levels = np.array([0.01, 0.5, 0.95, 0.999])
    q = tails.qtukey(levels, np.full(4, k), np.full(4, df))
    assert tails.ptukey_sf(q, np.full(4, k), np.full(4, df)) == pytest.approx(1 - levels, rel=1e-8)
    if k == 2:
        assert q[2] == pytest.approx(2 ** 0.5 * tails.t_quantile(0.025, np.array([df]))[0], rel=1e-6)


def test_chi_square_points():
    assert tails.chi2_sf([3.841459, 5.991465, 7.814728], [1, 2, 3]) == pytest.approx([0.05] * 3, abs=1e-6)


def test_t_quantile_points():
    found = [tails.t_quantile(0.025, np.array([df]))[0] for df in (1.0, 2.0, 10.0, 24.0)]
    assert found == pytest.approx([12.706205, 4.302653, 2.228139, 2.063899], abs=1e-6)


def test_paired_power_and_size():
    assert tails.paired_power([20.0], [0.5], 0.05)[0] == pytest.approx(0.564504, abs=1e-5)
    assert tails.paired_sample_size([0.5, -0.2], 0.8, 0.05) == pytest.approx([33.36713, 198.15082], abs=1e-3)


def test_smallest_number_of_pairs():
    d = np.array([0.5, -0.2, 0.01, 3.0, 40.0, 0.0])
    n = tails.smallest_pairs(d, 0.8, 0.05)
    assert n[:2].tolist() == [34, 199] and np.isnan(n[5]) and n[4] == 2
    assert (tails.paired_power(n[:4], d[:4], 0.05) >= 0.8).all()
    assert (tails.paired_power(n[:4] - 1, d[:4], 0.05) < 0.8).all()
    assert np.isnan(tails.smallest_pairs(np.array([1e-9]), 0.8, 0.05, most=1e6)).all()


def test_sample_size_without_solution():
    assert np.isnan(tails.paired_sample_size([0.0, 50.0], 0.8, 0.05)).all()


def test_signed_rank_exact_against_enumeration():
    n, v = 6, 4
    sums = [sum(r for r in range(1, n + 1) if bits >> (r - 1) & 1) for bits in range(2 ** n)]
    assert tails.signed_rank_exact(v, n) == pytest.approx(2 * sum(s <= v for s in sums) / 2 ** n)


def test_signed_rank_normal_continuity():
    z = (40 - 10 * 11 / 4 - 0.5) / np.sqrt(10 * 11 * 21 / 24)
    assert tails.signed_rank_normal(40, 10, 0) == pytest.approx(2 * tails.normal_sf(z))


def test_null_and_nan_become_null(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (0.0, 2.0)], "f double, df double")
    found = [r.p for r in rows.select(tails.chi2_tail(F.col("f"), F.col("df")).alias("p")).collect()]
    assert found[0] == pytest.approx(np.exp(-0.5)) and found[1] is None and found[2] == 1.0
