"""Distribution functions for p values.

They run on aggregated results only (a few rows); the Column forms of the normal
distribution are for row-level use.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of a published rational approximation of the normal quantile.
PPF_A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
PPF_B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01)
PPF_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
PPF_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00)
# Chebyshev coefficients of the complementary error function.
ERFC = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def norm_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2))


def _horner(coefs, x):
    total = coefs[0]
    for c in coefs[1:]:
        total = total * x + c
    return total


def norm_ppf(p: float) -> float:
    if p <= 0 or p >= 1:
        return -math.inf if p <= 0 else math.inf
    if p < 0.02425:
        q = math.sqrt(-2 * math.log(p))
        x = _horner(PPF_C, q) / _horner((*PPF_D, 1.0), q)
    elif p > 1 - 0.02425:
        return -norm_ppf(1 - p)
    else:
        q = p - 0.5
        x = q * _horner(PPF_A, q * q) / _horner((*PPF_B, 1.0), q * q)
    err = norm_cdf(x) - p
    step = err * math.sqrt(2 * math.pi) * math.exp(x * x / 2)
    return x - step / (1 + x * step / 2)


def gamma_p(a: float, x: float) -> float:
    """Regularized lower incomplete gamma."""
    if x <= 0:
        return 0.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return min(1.0, total * front)
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1 / ((an * d + b) or tiny)
        c = (b + an / c) or tiny
        h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return max(0.0, 1 - front * h)


def beta_i(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_i(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    c, d = 1.0, 1 / ((1 - (a + b) * x / (a + 1)) or tiny)
    h = d
    for m in range(1, 10_000):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 / ((1 + num * d) or tiny)
            c = (1 + num / c) or tiny
            h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return front * h


def chi2_sf(x: float, df: float) -> float:
    return 1 - gamma_p(df / 2, x / 2)


def chi2_ppf(p: float, df: float) -> float:
    lo, hi = 0.0, max(10.0, 4 * df + 40)
    while gamma_p(df / 2, hi / 2) < p:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if gamma_p(df / 2, mid / 2) < p else (lo, mid)
    return (lo + hi) / 2


def t_sf2(t: float, df: float) -> float:
    """Two-sided tail of Student's t."""
    return beta_i(df / 2, 0.5, df / (df + t * t))


def f_sf(f: float, d1: float, d2: float) -> float:
    return beta_i(d2 / 2, d1 / 2, d2 / (d2 + d1 * f)) if f > 0 else 1.0


def kolmogorov_sf(x: float) -> float:
    if x <= 0.2:
        return 1.0
    return max(0.0, min(1.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 101))))


def ks_two_sample_p(d: float, n: float, m: float) -> float:
    return kolmogorov_sf(d * math.sqrt(n * m / (n + m)))


def ks_one_sample_p(d: float, n: float) -> float:
    return kolmogorov_sf(d * math.sqrt(n))


def digamma(x: float) -> float:
    shift = 0.0
    while x < 6:
        shift -= 1 / x
        x += 1
    y = 1 / (x * x)
    return shift + math.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132))))


def trigamma(x: float) -> float:
    shift = 0.0
    while x < 6:
        shift += 1 / (x * x)
        x += 1
    y = 1 / (x * x)
    return shift + 1 / x + y / 2 + y / x * (1 / 6 - y * (1 / 30 - y * (1 / 42 - y / 30)))


def on_results(fn: Callable[..., float]) -> Callable[..., Column]:
    """A scalar statistic as a vectorized Column function, for small result tables."""

    @F.pandas_udf("double")
    def run(frame: pd.DataFrame) -> pd.Series:
        return pd.Series(
            [None if any(pd.isna(v) for v in row) else float(fn(*row)) for row in frame.itertuples(index=False)],
            dtype="float64",
        )

    return lambda *cols: run(F.struct(*[F.col(c) if isinstance(c, str) else c for c in cols]))


def _col_horner(coefs, x: Column) -> Column:
    total = F.lit(coefs[0])
    for c in coefs[1:]:
        total = total * x + F.lit(c)
    return total


def norm_ppf_col(p: Column) -> Column:
    """Normal quantile of a Column (relative error about 1e-9); NULL outside (0, 1)."""
    low = F.sqrt(F.lit(-2.0) * F.ln(p))
    high = F.sqrt(F.lit(-2.0) * F.ln(1 - p))
    q = p - 0.5
    tail = lambda z: _col_horner(PPF_C, z) / _col_horner((*PPF_D, 1.0), z)
    return (
        F.when((p <= 0) | (p >= 1), None)
        .when(p < 0.02425, tail(low))
        .when(p > 1 - 0.02425, -tail(high))
        .otherwise(q * _col_horner(PPF_A, q * q) / _col_horner((*PPF_B, 1.0), q * q))
    )


def norm_ppf_array(p: np.ndarray) -> np.ndarray:
    """``norm_ppf_col`` on an array whose numbers lie inside (0, 1)."""
    q, rim = p - 0.5, np.sqrt(-2.0 * np.log(np.minimum(p, 1 - p)))
    tail = _ratio(PPF_C, PPF_D, rim)
    return np.where(p < 0.02425, tail, np.where(p > 1 - 0.02425, -tail, q * _ratio(PPF_A, PPF_B, q * q)))


def _ratio(over, under, x: np.ndarray) -> np.ndarray:
    return _horner(over, x) / _horner((*under, 1.0), x)


def norm_cdf_col(x: Column) -> Column:
    """Normal distribution function of a Column (relative error about 1e-7)."""
    z = F.abs(x) / F.lit(math.sqrt(2))
    t = 1 / (1 + z / 2)
    tail = t * F.exp(-z * z + _col_horner(tuple(reversed(ERFC)), t))
    return F.when(x >= 0, 1 - tail / 2).otherwise(tail / 2)
