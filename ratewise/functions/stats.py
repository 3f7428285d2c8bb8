"""Aggregate expressions and small numeric helpers."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ratewise.functions.columns import as_column


def rate_pct(y: str | Column, digits: int | None = 2) -> Column:
    """Share of ones in percent."""
    pct = F.avg(as_column(y)) * 100
    return pct if digits is None else F.round(pct, digits)


def pearson(x: str | Column, y: str | Column) -> Column:
    """Pearson r over rows where both are present (NaN is not); null when either side is constant
    (``corr`` itself raises a division by zero there)."""
    known = lambda c: F.when(~F.isnan(as_column(c).cast("double")), as_column(c).cast("double"))
    x, y = known(x), known(y)
    sx = F.stddev_pop(F.when(y.isNotNull(), x))
    sy = F.stddev_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), sx * sy)


def sample_skewness(c: str | Column) -> Column:
    """Bias-corrected skewness G1; null below three values or for a constant column."""
    c = as_column(c).cast("double")
    n = F.count(c).cast("double")
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))


def sample_kurtosis(c: str | Column) -> Column:
    """Bias-corrected excess kurtosis G2; null below four values or for a constant column."""
    c = as_column(c).cast("double")
    n = F.count(c).cast("double")
    scale = F.try_divide(n - 1, (n - 2) * (n - 3))
    return F.when(n > 3, scale * ((n + 1) * F.kurtosis(c) + 6))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz iteration)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 400):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            value *= d * c
        if abs(d * c - 1.0) < 1e-14:
            break
    return value


def regularized_beta(a: float, b: float, x: float) -> float:
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


def correlation_p_value(r: float | None, n: float | None) -> float | None:
    """Two-sided Student-t p-value of a Pearson r over n pairs."""
    if r is None or n is None or math.isnan(r) or n < 3:
        return None
    if abs(r) >= 1.0:
        return 0.0
    dof = n - 2.0
    t2 = r * r * dof / (1.0 - r * r)
    return regularized_beta(dof / 2.0, 0.5, dof / (dof + t2))


def p_value_column(r: str | Column, n: str | Column) -> Column:
    """``correlation_p_value`` on an already aggregated (few-row) frame."""

    @F.pandas_udf("double")
    def run(rs: pd.Series, ns: pd.Series) -> pd.Series:
        pairs = zip(rs.tolist(), ns.tolist())
        return pd.Series([correlation_p_value(a, b) if pd.notna(a) else None for a, b in pairs], dtype="float64")

    return run(as_column(r).cast("double"), as_column(n).cast("double"))
