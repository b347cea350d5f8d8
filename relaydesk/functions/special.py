"""Two-sided p-value of a correlation coefficient; applied to one aggregate row."""

from __future__ import annotations

import math

from pyspark.sql import functions as F
from pyspark.sql import types as T


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 / max(1.0 - (a + b) * x / (a + 1.0), tiny)
    value = d
    for m in range(1, 500):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 + term * d
            c = 1.0 + term / c
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return value


def beta_regularized(a: float, b: float, x: float) -> float:
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


@F.udf(returnType=T.DoubleType(), useArrow=False)
def correlation_p_value(r: float | None, n: int | None) -> float | None:
    """P(|R| >= |r|) for ``n`` pairs without correlation: Student t with n - 2 degrees of freedom."""
    if r is None or n is None or math.isnan(r):
        return None
    if n < 3:
        return 1.0 if n == 2 else None
    return beta_regularized((n - 2) / 2.0, 0.5, max(0.0, 1.0 - r * r))
