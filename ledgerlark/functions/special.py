"""Tail probabilities and quantiles for result rows (one per feature or experiment, never data rows).

Series that SQL can express are Column expressions; the others are small pandas UDFs.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

SERIES_TERMS = 100


def kolmogorov_tail(effective_root_n_times_d: Column) -> Column:
    """Asymptotic two-sided tail 2 Σ (-1)^(k-1) exp(-2 k² λ²), cut to 0..1."""
    lam = effective_root_n_times_d
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(SERIES_TERMS)),
        lambda k: F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam * lam),
    )
    total = 2.0 * F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)
    # below this point the alternating series is 1 to many digits but no longer converges in 100 terms
    return F.when(lam < 0.1, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(total, F.lit(1.0))))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300

    def safe(v: float) -> float:
        return v if abs(v) > tiny else tiny

    c, d = 1.0, 1.0 / safe(1.0 - (a + b) * x / (a + 1.0))
    out = d
    for i in range(1, 2000):
        even = i * (b - i) * x / ((a + 2 * i - 1) * (a + 2 * i))
        d, c = 1.0 / safe(1.0 + even * d), safe(1.0 + even / c)
        out *= d * c
        odd = -(a + i) * (a + b + i) * x / ((a + 2 * i) * (a + 2 * i + 1))
        d, c = 1.0 / safe(1.0 + odd * d), safe(1.0 + odd / c)
        step = d * c
        out *= step
        if abs(step - 1.0) < 1e-15:
            break
    return out


def beta_regularised(a: float, b: float, x: float) -> float:
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def t_two_sided(t: float, df: float) -> float:
    if math.isinf(t):
        return 0.0
    return beta_regularised(df / 2.0, 0.5, df / (df + t * t))


def t_quantile(p: float, df: float) -> float:
    """Upper quantile for p > 0.5, by bisection on the two-sided tail."""
    tail, low, high = 2.0 * (1.0 - p), 0.0, 2.0
    while t_two_sided(high, df) > tail:
        high *= 2.0
    for _ in range(200):
        mid = (low + high) / 2.0
        low, high = (mid, high) if t_two_sided(mid, df) > tail else (low, mid)
    return (low + high) / 2.0


def gamma_upper(s: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0.0:
        return 1.0
    if math.isinf(x):
        return 0.0
    front = math.exp(s * math.log(x) - x - math.lgamma(s))
    if x < s + 1.0:
        term = total = 1.0 / s
        k = s
        while abs(term) > abs(total) * 1e-16:
            k += 1.0
            term *= x / k
            total += term
        return 1.0 - front * total
    tiny = 1e-300
    b = x + 1.0 - s
    c, d = 1.0 / tiny, 1.0 / b
    out = d
    for i in range(1, 5000):
        an = -i * (i - s)
        b += 2.0
        d = 1.0 / (an * d + b or tiny)
        c = b + an / c or tiny
        step = d * c
        out *= step
        if abs(step - 1.0) < 1e-15:
            break
    return front * out


def chi2_tail_value(x: float, df: float) -> float:
    return gamma_upper(df / 2.0, x / 2.0)


@F.pandas_udf(DoubleType())
def normal_two_sided(z: pd.Series) -> pd.Series:
    return z.map(lambda v: None if pd.isna(v) else math.erfc(abs(v) / math.sqrt(2.0)))


@F.pandas_udf(DoubleType())
def t_tail(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(a) or pd.isna(b) else t_two_sided(a, b) for a, b in zip(t, df)], dtype="float64")


@F.pandas_udf(DoubleType())
def t_critical(p: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(b) else t_quantile(a, b) for a, b in zip(p, df)], dtype="float64")


@F.pandas_udf(DoubleType())
def chi2_tail(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(a) else chi2_tail_value(a, b) for a, b in zip(x, df)], dtype="float64")


@F.pandas_udf(DoubleType())
def f_tail(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series(
        [None if pd.isna(x) else beta_regularised(b / 2.0, a / 2.0, b / (b + a * x)) for x, a, b in zip(f, d1, d2)],
        dtype="float64",
    )
