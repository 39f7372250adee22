"""Tail probabilities for test statistics.

These are Arrow-batched UDFs because Spark has no distribution functions. They
only ever see the one or few result rows of a test, never data rows.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 500):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + numerator / c
            c = c if abs(c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return value


def regularized_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b)
        - math.lgamma(a)
        - math.lgamma(b)
        + a * math.log(x)
        + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def student_p(t: float | None, dof: float | None) -> float | None:
    """Two-sided p-value of Student's t."""
    if t is None or dof is None or dof <= 0 or math.isnan(t):
        return None
    if math.isinf(t):
        return 0.0
    return regularized_beta(dof / 2.0, 0.5, dof / (dof + t * t))


def exact_rank_sum_p(u: float, n1: int, n2: int) -> float:
    """Two-sided exact p-value of U without ties, from the null distribution's counts."""
    few, many = min(n1, n2), max(n1, n2)
    counts = np.zeros(n1 * n2 + 1)
    counts[0] = 1.0
    for i in range(1, few + 1):
        # multiply by (1 - q^(many+i)) / (1 - q^i), the Gaussian binomial recurrence
        top = many + i
        if top <= n1 * n2:
            counts[top:] -= counts[: n1 * n2 + 1 - top].copy()
        for start in range(i):
            counts[start::i] = np.cumsum(counts[start::i])
        counts /= counts.max()
    upper = counts[int(math.ceil(max(u, n1 * n2 - u))) :].sum() / counts.sum()
    return min(1.0, 2.0 * upper)


def uniform_sum_p(u: float, n1: int, n2: int) -> float:
    """Two-sided p-value of U for one tiny and one huge sample: the limit is a sum of uniforms.

    Differs from the exact value by the order of 1 / max(n1, n2).
    """
    few, many = min(n1, n2), max(n1, n2)
    x = Fraction(int(math.floor(min(u, n1 * n2 - u)))) / many + Fraction(1, 2 * many)
    lower = sum((-1) ** k * math.comb(few, k) * max(x - k, 0) ** few for k in range(few + 1))
    return min(1.0, 2.0 * float(lower / math.factorial(few)))


EXACT_CELLS = 1 << 23


def rank_sum_p(u: float, n1: int, n2: int, tie_sum: float) -> float | None:
    """Two-sided p-value of U: exact for a sample of up to 8 without ties, else normal.

    Where the null distribution has more than EXACT_CELLS places, its limit is used.
    """
    if not n1 or not n2 or u is None:
        return None
    if tie_sum == 0 and min(n1, n2) <= 8:
        return exact_rank_sum_p(u, n1, n2) if n1 * n2 < EXACT_CELLS else uniform_sum_p(u, n1, n2)
    n = n1 + n2
    spread = math.sqrt(n1 * n2 / 12.0 * ((n + 1) - tie_sum / (n * (n - 1.0))))
    if spread == 0:
        return 1.0
    z = (max(u, n1 * n2 - u) - n1 * n2 / 2.0 - 0.5) / spread
    return min(1.0, math.erfc(z / math.sqrt(2.0)))


def _clean(*values):
    return [None if v is None or pd.isna(v) else v for v in values]


@F.pandas_udf(T.DoubleType())
def t_p_value(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([student_p(*_clean(a, b)) for a, b in zip(t, dof)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def u_p_value(u: pd.Series, n1: pd.Series, n2: pd.Series, ties: pd.Series) -> pd.Series:
    rows = zip(u, n1, n2, ties)
    return pd.Series([rank_sum_p(*_clean(*r)) for r in rows], dtype="float64")
