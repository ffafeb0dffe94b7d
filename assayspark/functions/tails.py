"""Probability tails that Spark SQL lacks, as Arrow functions for small summary tables.

Only summary rows (one per analyte or pair) pass through them, never measurements.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: From here on Stirling's series gives log gamma to the last digit.
LARGE = 16.0
#: Parts of an integral below exp(-DROP) of its largest value are left out.
DROP = 46.0
#: Points of a grid that looks for the stretch where an integrand counts.
GRID = 33


# Cody's rational approximations of erf below 0.46875, of erfc up to 4, and of erfc beyond.
_ERF_TOP = (1.85777706184603153e-1, 3.16112374387056560, 1.13864154151050156e2, 3.77485237685302021e2, 3.20937758913846947e3)
_ERF_BOTTOM = (1.0, 2.36012909523441209e1, 2.44024637934444173e2, 1.28261652607737228e3, 2.84423683343917062e3)
_MIDDLE_TOP = (2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594, 6.61191906371416295e1,
               2.98635138197400131e2, 8.81952221241769090e2, 1.71204761263407058e3, 2.05107837782607147e3, 1.23033935479799725e3)
_MIDDLE_BOTTOM = (1.0, 1.57449261107098347e1, 1.17693950891312499e2, 5.37181101862009858e2, 1.62138957456669019e3,
                  3.29079923573345963e3, 4.36261909014324716e3, 3.43936767414372164e3, 1.23033935480374942e3)
_FAR_TOP = (1.63153871373020978e-2, 3.05326634961232344e-1, 3.60344899949804439e-1, 1.25781726111229246e-1,
            1.60837851487422766e-2, 6.58749161529837803e-4)
_FAR_BOTTOM = (1.0, 2.56852019228982242, 1.87295284992346725, 5.27905102951428412e-1, 6.05183413124413191e-2,
               2.33520497626869185e-3)


def _erfc(x: np.ndarray) -> np.ndarray:
    """Complementary error function of whole arrays."""
    size = np.abs(x)
    out = np.empty_like(size)
    near, far = size < 0.46875, size > 4
    z = size[near]
    out[near] = 1 - z * np.polyval(_ERF_TOP, z * z) / np.polyval(_ERF_BOTTOM, z * z)
    z = size[~near & ~far]
    out[~near & ~far] = np.exp(-z * z) * np.polyval(_MIDDLE_TOP, z) / np.polyval(_MIDDLE_BOTTOM, z)
    z = np.minimum(size[far], 40.0)
    u = 1 / (z * z)
    out[far] = np.exp(-z * z) / z * (1 / math.sqrt(math.pi) - u * np.polyval(_FAR_TOP, u) / np.polyval(_FAR_BOTTOM, u))
    return np.where(x < 0, 2 - out, out)


def normal_sf(x: np.ndarray) -> np.ndarray:
    return 0.5 * _erfc(np.asarray(x, float) / math.sqrt(2))


def log_gamma(x: np.ndarray) -> np.ndarray:
    return np.asarray(np.frompyfunc(math.lgamma, 1, 1)(np.asarray(x, float)), float)


def _stirling_rest(x: np.ndarray) -> np.ndarray:
    """What Stirling's formula leaves of log gamma, for x of 16 or more."""
    u = 1 / (x * x)
    return (1 / 12 - u * (1 / 360 - u * (1 / 1260 - u * (1 / 1680 - u / 1188)))) / x


def log_gamma_step(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """log gamma(a + b) - log gamma(b) without the cancellation of two large numbers."""
    a, b = np.broadcast_arrays(np.asarray(a, float), np.asarray(b, float))
    large = np.maximum(b, LARGE)
    by_series = (
        (large - 0.5) * np.log1p(a / large) + a * (np.log(a + large) - 1)
        + _stirling_rest(a + large) - _stirling_rest(large)
    )
    return np.where(b >= LARGE, by_series, log_gamma(a + b) - log_gamma(b))


def _log_front(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """log of x^a y^b / B(a, b), where y = 1 - x is given, so that neither side loses digits."""
    log_x = np.where(y < 0.5, np.log1p(-np.minimum(y, 0.5)), np.log(x))
    log_y = np.where(x < 0.5, np.log1p(-np.minimum(x, 0.5)), np.log(y))
    small, other = np.minimum(a, b), np.maximum(a, b)
    plain = a * log_x + b * log_y + log_gamma_step(small, other) - log_gamma(small)
    # Both large: deviations from the mean a / (a + b) instead of a log x + b log y.
    big_a, big_b = np.maximum(a, LARGE), np.maximum(b, LARGE)
    off = x * big_b - y * big_a
    deviance = big_a * _log1p_rest(off / big_a) + big_b * _log1p_rest(-off / big_b)
    both = (
        deviance + 0.5 * np.log(big_a / (big_a + big_b) * big_b / (2 * math.pi))
        - _stirling_rest(big_a) - _stirling_rest(big_b) + _stirling_rest(big_a + big_b)
    )
    return np.where(small >= LARGE, both, plain)


def _log1p_rest(e: np.ndarray) -> np.ndarray:
    """log(1 + e) - e."""
    near = np.where(np.abs(e) < 0.01, e, 0.0)
    series = np.zeros_like(near)
    for k in range(9, 1, -1):
        series = (-1) ** (k + 1) / k + near * series
    return np.where(np.abs(e) < 0.01, near * near * series, np.log1p(np.maximum(e, -1.0)) - e)


def _integral(h, scale: np.ndarray) -> np.ndarray:
    """Integral over w > 0 of exp(h(w)), h(0) = 0 being concave and falling, one row per element of scale.

    The range ends where h is below -DROP; its first sixteenth, the rest of its first quarter and the rest are three panels.
    """
    end = scale.copy()
    for _ in range(200):
        short = h(end[:, None])[:, 0] > -DROP
        if not short.any():
            break
        end = np.where(short, end * 2, end)
    low = np.zeros_like(end)
    for _ in range(12):
        middle = (low + end) / 2
        short = h(middle[:, None])[:, 0] > -DROP
        low, end = np.where(short, middle, low), np.where(short, end, middle)
    node, weight = np.polynomial.legendre.leggauss(48)
    total = np.zeros_like(end)
    for left, right in ((0.0, 1 / 16), (1 / 16, 1 / 4), (1 / 4, 1.0)):
        w = end[:, None] * (left + (right - left) * (node + 1) / 2)
        total += (np.exp(h(w)) * weight).sum(axis=1) * end * (right - left) / 2
    return total


def beta_upper(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """P(X > x) of a beta variable with parameters a and b; y = 1 - x is passed in.

    The tail on the far side of the mean is integrated itself, over the log odds from x outward, where the density is
    log-concave. Small tails keep their relative precision, and large parameters cost nothing.
    """
    a, b, x, y = (np.array(v, float) for v in np.broadcast_arrays(a, b, x, y))
    turned = x * b < y * a
    a, b, x, y = np.where(turned, b, a), np.where(turned, a, b), np.where(turned, y, x), np.where(turned, x, y)
    tail = np.zeros_like(x)
    inner = np.flatnonzero(y > 0)
    if len(inner):
        p, q, u, v = (z[inner] for z in (a, b, x, y))
        column = [z[:, None] for z in (p, q, u)]

        def h(w: np.ndarray) -> np.ndarray:
            with np.errstate(over="ignore"):
                return column[0] * w - (column[0] + column[1]) * np.log1p(column[2] * np.expm1(np.minimum(w, 700.0)))

        slope = np.maximum(u * q - v * p, 0.0)
        scale = 1 / (slope + np.sqrt((p + q) * u * v) + 1e-300)
        with np.errstate(under="ignore"):
            tail[inner] = np.exp(_log_front(p, q, u, v)) * _integral(h, scale)
    tail = np.minimum(tail, 1.0)
    return np.where(turned, 1 - tail, tail)


def f_sf(f: np.ndarray, df1: np.ndarray, df2: np.ndarray) -> np.ndarray:
    f, df1, df2 = (np.asarray(v, float) for v in (f, df1, df2))
    whole = df2 + df1 * f
    with np.errstate(invalid="ignore"):
        x = np.where(np.isinf(f), 1.0, df1 * f / whole)
    return beta_upper(df1 / 2, df2 / 2, x, df2 / whole)


def t_sf(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    t, df = np.asarray(t, float), np.asarray(df, float)
    whole = df + t * t
    with np.errstate(invalid="ignore"):
        x = np.where(np.isinf(whole), 1.0, t * t / whole)
    tail = beta_upper(0.5, df / 2, x, df / whole) / 2
    return np.where(t >= 0, tail, 1 - tail)


def chi2_sf(x: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Upper incomplete gamma by stepping the degrees of freedom up by two."""
    out = []
    for value, freedom in zip(np.asarray(x, float), np.asarray(df, float), strict=True):
        half = value / 2
        odd = int(freedom) % 2
        tail = math.erfc(math.sqrt(half)) if odd else 0.0
        for step in range(int(freedom) // 2):
            power = step + (0.5 if odd else 0.0)
            if half > 0:
                tail += math.exp(power * math.log(half) - half - math.lgamma(power + 1))
            elif power == 0:
                tail += 1.0
        out.append(min(tail, 1.0))
    return np.array(out)


def _log_scaled_chi(e: np.ndarray, log_s: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Log density of sqrt(chi2(df) / df) at 1 + e, whose log is passed in."""
    half = df / 2
    large = np.maximum(half, LARGE)
    constant = np.where(
        half >= LARGE, 0.5 * np.log(large / (2 * math.pi)) - _stirling_rest(large),
        half * np.log(half) - half - log_gamma(half),
    )
    return math.log(2) + constant - log_s + half * (2 * log_s - e * (2 + e))


def _scaled_chi_grid(df: np.ndarray, points: int) -> tuple[np.ndarray, np.ndarray]:
    """Quadrature nodes and weights of sqrt(chi2(df) / df), one row per df."""
    node, weight = np.polynomial.legendre.leggauss(points)
    width = (8 / np.sqrt(2 * df))[:, None]
    low = np.maximum(-1.0, -width)
    e = (width - low) / 2 * node + (width + low) / 2
    return 1 + e, np.exp(_log_scaled_chi(e, np.log1p(e), df[:, None])) * weight * (width - low) / 2


def range_upper(w: np.ndarray, k: np.ndarray, points: int = 96) -> np.ndarray:
    """Upper tail of the range of k standard normal values, integrated over the largest of them.

    With A = Phi(z) and B = Phi(z - w), A^(k-1) - (A - B)^(k-1) is written with log1p and expm1, so the tail is never
    one minus something near one.
    """
    w, k = np.broadcast_arrays(np.asarray(w, float), np.asarray(k, float))
    node, weight = np.polynomial.legendre.leggauss(points)
    high = np.maximum(8.5, w / 2 + 8.5)[..., None]
    z = (high + 8.5) / 2 * (node + 1) - 8.5
    below = normal_sf(-z)
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.minimum(normal_sf(w[..., None] - z) / below, 1.0)
        power = (k - 1)[..., None]
        gap = np.power(below, power) * -np.expm1(power * np.log1p(-ratio))
    density = np.exp(-z * z / 2) / math.sqrt(2 * math.pi)
    return k * (density * np.nan_to_num(gap) * weight).sum(axis=-1) * (high[..., 0] + 8.5) / 2


def ptukey_sf(q: np.ndarray, k: np.ndarray, df: np.ndarray, points: int = 64) -> np.ndarray:
    """Upper tail of the studentized range of k means.

    The tail of the range is averaged over the log of the scale. For large q that average comes from small scales, so the
    stretch that counts is found first, on grids of GRID points, each within the stretch of the one before.
    """
    q, k, df = (np.asarray(v, float) for v in (q, k, df))
    q = np.minimum(q, 1e100)
    out = np.empty(len(q))
    for i in range(len(q)):
        if q[i] <= 0:
            out[i] = 1.0
            continue

        def log_term(t: np.ndarray, i=i, points=24) -> np.ndarray:
            with np.errstate(divide="ignore"):
                return _log_scaled_chi(np.expm1(t), t, df[i]) + t + np.log(range_upper(q[i] * np.exp(t), k[i], points))

        spread = 10 / math.sqrt(2 * df[i]) + 60 / df[i]
        low, high = -0.5 * math.log1p(q[i] * q[i] / (2 * df[i])) - spread, min(spread, 5.0)
        for _ in range(3):
            t = np.linspace(low, high, GRID)
            term = log_term(t)
            near = np.flatnonzero(term > term.max() - DROP)
            if not len(near):
                break
            step = (high - low) / (GRID - 1)
            low, high = t[near[0]] - step, t[near[-1]] + step
            if near[-1] - near[0] > GRID // 3:
                break
        # With few degrees of freedom the stretch is long against the bend of the integrand.
        wide = (high - low) * math.sqrt(2 * df[i]) > points / 2
        node, weight = np.polynomial.legendre.leggauss(4 * points if wide else points)
        t = (high - low) / 2 * (node + 1) + low
        out[i] = (np.exp(log_term(t, points=96)) * weight).sum() * (high - low) / 2
    return np.clip(np.nan_to_num(out), 0.0, 1.0)


def qtukey(p: np.ndarray, k: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Quantile of the studentized range: secant steps on the log of the tail, all different rows at once, kept in a bracket."""
    rows, back = np.unique(np.stack([np.asarray(v, float) for v in (p, k, df)], axis=1), axis=0, return_inverse=True)
    p, k, df = rows.T
    wanted = np.log1p(-p)

    def above(q: np.ndarray, at: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return np.log(ptukey_sf(q, k[at], df[at])) - wanted[at]

    low, high = np.zeros(len(rows)), np.full(len(rows), 8.0)
    open_rows = np.arange(len(rows))
    while len(open_rows):
        open_rows = open_rows[above(high[open_rows], open_rows) > 0]
        low[open_rows] = high[open_rows]
        high[open_rows] *= 2
    before = np.maximum(low, high / 4)
    now = (before + high) / 2
    open_rows = np.arange(len(rows))
    f_before = above(before, open_rows)
    for _ in range(60):
        at = open_rows
        f_now = above(now[at], at)
        low[at], high[at] = np.where(f_now > 0, now[at], low[at]), np.where(f_now > 0, high[at], now[at])
        with np.errstate(divide="ignore", invalid="ignore"):
            step = now[at] - f_now * (now[at] - before[at]) / (f_now - f_before[at])
        inside = (step > low[at]) & (step < high[at])
        following = np.where(inside, step, (low[at] + high[at]) / 2)
        done = np.abs(following - now[at]) <= 1e-11 * (1 + following)
        before[at], f_before[at], now[at] = now[at], f_now, following
        open_rows = at[~done]
        if not len(open_rows):
            break
    return now[back.ravel()]


def t_quantile(upper: float, df: np.ndarray) -> np.ndarray:
    """Upper quantile by Newton steps; the tail is convex, so steps from the normal quantile never overshoot."""
    df = np.asarray(df, float)
    t = np.full(len(df), NormalDist().inv_cdf(1 - upper))
    log_scale = log_gamma_step(0.5, df / 2) - np.log(df * math.pi) / 2
    for _ in range(60):
        density = np.exp(log_scale - (df + 1) / 2 * np.log1p(t * t / df))
        step = (t_sf(t, df) - upper) / density
        t = t + step
        if np.all(np.abs(step) < 1e-10 * (1 + t)):
            break
    return t


def paired_power(n: np.ndarray, d: np.ndarray, alpha: float) -> np.ndarray:
    """Two-sided power of a paired t test of n pairs and effect size d (noncentral t)."""
    n, d = np.asarray(n, float), np.abs(np.asarray(d, float))
    df = n - 1
    critical = t_quantile(alpha / 2, df)[:, None]
    shift = (d * np.sqrt(n))[:, None]
    s, weight = _scaled_chi_grid(df, 96)
    rejected = normal_sf(critical * s - shift) + normal_sf(critical * s + shift)
    return np.clip((rejected * weight).sum(axis=1), 0.0, 1.0)


def paired_sample_size(d: np.ndarray, power: float, alpha: float) -> np.ndarray:
    """Pairs needed for the power, not rounded; NaN where two pairs already suffice or d is 0."""
    d = np.abs(np.asarray(d, float))
    out = np.full(len(d), np.nan)
    open_rows = np.flatnonzero((d > 0) & (paired_power(np.full(len(d), 2.0), d, alpha) < power))
    if len(open_rows) == 0:
        return out
    effect = d[open_rows]
    low, high = np.full(len(effect), 2.0), np.full(len(effect), 4.0)
    while np.any(short := (paired_power(high, effect, alpha) < power) & (high < 1e9)):
        high = np.where(short, high * 2, high)
    reached = paired_power(high, effect, alpha) >= power
    for _ in range(45):
        middle = (low + high) / 2
        below = paired_power(middle, effect, alpha) < power
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    out[open_rows] = np.where(reached, (low + high) / 2, np.nan)
    return out


def smallest_pairs(d: np.ndarray, power: float, alpha: float, most: float = 2.0 ** 40) -> np.ndarray:
    """The smallest whole number of pairs with the power; NaN where d is 0 or more than ``most`` pairs are needed.

    Power grows with the pairs: the answer is doubled up to, then halved down to, so power(n) reaches and power(n - 1) doesn't.
    """
    d = np.abs(np.asarray(d, float))
    out = np.full(len(d), np.nan)
    able = np.flatnonzero(d > 0)
    if not len(able):
        return out
    effect = d[able]
    low, high = np.ones(len(able)), np.full(len(able), 2.0)
    while np.any(short := (paired_power(high, effect, alpha) < power) & (high < most)):
        low, high = np.where(short, high, low), np.where(short, high * 2, high)
    reached = paired_power(high, effect, alpha) >= power
    while np.any(high - low > 1):
        middle = np.where(high - low > 1, np.floor((low + high) / 2), high)
        enough = paired_power(middle, effect, alpha) >= power
        low, high = np.where(enough, low, middle), np.where(enough, middle, high)
        low = np.minimum(low, high - 1)
    out[able] = np.where(reached, high, np.nan)
    return out


def signed_rank_exact(v: float, n: int) -> float:
    """Two-sided p of the signed-rank sum from the number of sign patterns per sum."""
    ways = np.zeros(n * (n + 1) // 2 + 1)
    ways[0] = 1
    for rank in range(1, n + 1):
        shifted = ways.copy()
        shifted[rank:] += ways[:-rank]
        ways = shifted
    ways /= 2.0 ** n
    v = int(round(v))
    tail = ways[v:].sum() if v > n * (n + 1) / 4 else ways[: v + 1].sum()
    return float(min(1.0, 2 * tail))


def signed_rank_normal(v: float, n: float, tie_sum: float) -> float:
    """Two-sided p by the normal approximation with continuity and tie correction."""
    z = v - n * (n + 1) / 4
    sigma = math.sqrt(n * (n + 1) * (2 * n + 1) / 24 - tie_sum / 48)
    if sigma == 0:
        return math.nan
    z = (z - math.copysign(0.5, z) if z else 0.0) / sigma
    return min(1.0, math.erfc(abs(z) / math.sqrt(2)))


def _null_safe(function, *series: pd.Series) -> pd.Series:
    """Apply an array function to the rows without missing input; NaN becomes NULL."""
    frame = pd.concat([s.astype("float64") for s in series], axis=1)
    whole = frame.notna().all(axis=1).to_numpy()
    out = np.full(len(frame), np.nan)
    if whole.any():
        out[whole] = function(*(frame.iloc[:, i].to_numpy()[whole] for i in range(frame.shape[1])))
    return pd.Series(out).astype("Float64").where(~np.isnan(out), pd.NA)


@F.pandas_udf(DoubleType())
def f_tail(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    return _null_safe(f_sf, f, df1, df2)


@F.pandas_udf(DoubleType())
def t_tail(t: pd.Series, df: pd.Series) -> pd.Series:
    return _null_safe(t_sf, t, df)


@F.pandas_udf(DoubleType())
def chi2_tail(x: pd.Series, df: pd.Series) -> pd.Series:
    return _null_safe(chi2_sf, x, df)


@F.pandas_udf(DoubleType())
def normal_tail(z: pd.Series) -> pd.Series:
    return _null_safe(normal_sf, z)


@F.pandas_udf(DoubleType())
def tukey_tail(q: pd.Series, k: pd.Series, df: pd.Series) -> pd.Series:
    return _null_safe(ptukey_sf, q, k, df)


@F.pandas_udf(DoubleType())
def tukey_quantile(p: pd.Series, k: pd.Series, df: pd.Series) -> pd.Series:
    return _null_safe(qtukey, p, k, df)


@F.pandas_udf(DoubleType())
def signed_rank_tail(v: pd.Series, n: pd.Series, tie_sum: pd.Series, exact: pd.Series) -> pd.Series:
    def tails(v, n, ties, exact):
        return np.array([
            signed_rank_exact(a, int(b)) if e else signed_rank_normal(a, b, c)
            for a, b, c, e in zip(v, n, ties, exact, strict=True)
        ])

    return _null_safe(tails, v, n, tie_sum, exact)


@F.pandas_udf(DoubleType())
def paired_t_power(n: pd.Series, d: pd.Series, alpha: pd.Series) -> pd.Series:
    return _null_safe(lambda a, b, c: paired_power(a, b, float(c[0])), n.where(n >= 2), d, alpha)


@F.pandas_udf(DoubleType())
def paired_t_sample_size(d: pd.Series, power: pd.Series, alpha: pd.Series) -> pd.Series:
    return _null_safe(lambda a, b, c: paired_sample_size(a, float(b[0]), float(c[0])), d, power, alpha)


@F.pandas_udf(DoubleType())
def paired_t_smallest(d: pd.Series, power: pd.Series, alpha: pd.Series) -> pd.Series:
    return _null_safe(lambda a, b, c: smallest_pairs(a, float(b[0]), float(c[0])), d, power, alpha)
