"""Tail probabilities as Arrow functions and the closed forms used in plans. No row-at-a-time Python."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Median of the chi-squared distribution with one degree of freedom.
CHI2_MEDIAN = 0.4549364231195724


def _fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 400):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1 + top * d, 1 + top / c
            d, c = 1 / (d if abs(d) > tiny else tiny), c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * _fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * _fraction(b, a, 1 - x) / b


def upper_gamma(s: float, x: float) -> float:
    """Regularised upper incomplete gamma function by series or continued fraction."""
    if x <= 0:
        return 1.0
    scale = math.exp(s * math.log(x) - x - math.lgamma(s))
    if x < s + 1:
        term = total = 1 / s
        k = s
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return 1 - total * scale
    b = x + 1 - s
    c, d = 1e300, 1 / b
    h = d
    for i in range(1, 500):
        an = -i * (i - s)
        b += 2
        d, c = 1 / (an * d + b), b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h * scale


def _each(function, *columns: pd.Series) -> pd.Series:
    rows = zip(*(c.to_numpy(dtype=float, na_value=np.nan) for c in columns), strict=True)
    return pd.Series([None if any(map(math.isnan, r)) else function(*r) for r in rows], dtype="float64")


@F.pandas_udf(DoubleType())
def normal_two_sided(z: pd.Series) -> pd.Series:
    """Two-sided p of a normal z; null for null or NaN."""
    return _each(lambda v: math.erfc(abs(v) / math.sqrt(2)), z)


@F.pandas_udf(DoubleType())
def t_two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p of Student's t; null where df is below 1."""
    return _each(lambda v, n: math.nan if n < 1 else 0.0 if math.isinf(v) else incomplete_beta(n / 2, 0.5, n / (n + v * v)), t, df)


@F.pandas_udf(DoubleType())
def chi2_upper(x: pd.Series, df: pd.Series) -> pd.Series:
    """Upper tail of the chi-squared distribution; null where df is below 1."""
    return _each(lambda v, n: math.nan if n < 1 else upper_gamma(n / 2, v / 2), x, df)


def z_of_p(p: Column) -> Column:
    """|z| of a two-sided p, by the rational approximation of Abramowitz and Stegun 26.2.23 (error below 4.5e-4)."""
    t = F.sqrt(-2 * F.ln(F.greatest(F.when((p >= 0) & (p <= 1), p), F.lit(1e-300)) / 2))
    return F.greatest(t - (2.515517 + 0.802853 * t + 0.010328 * t * t) / (1 + 1.432788 * t + 0.189269 * t * t + 0.001308 * t * t * t), F.lit(0.0))


def liability_r2(log_odds: Column, f_cases: Column, f_controls: Column, prevalence: Column) -> Column:
    """Share of the liability's variance that a variant explains, from its frequencies in cases and controls."""
    f = prevalence * f_cases + (1 - prevalence) * f_controls
    v = log_odds * log_odds * 2 * f * (1 - f)
    return v / (v + math.pi**2 / 3)


def finite(value: Column) -> Column:
    """The value, null for NaN and infinities."""
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)
