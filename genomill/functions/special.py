"""Special functions that Spark SQL lacks, as column expressions or plain Python."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Coefficients of the Chebyshev fit of erfc of Numerical Recipes (fixed values; the
#: fractional error is below 1.2e-7 everywhere).
ERFC = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def erfc(x: Column) -> Column:
    """Complementary error function of a non-negative column."""
    t = 1 / (1 + 0.5 * x)
    poly = F.lit(ERFC[-1])
    for c in reversed(ERFC[:-1]):
        poly = F.lit(c) + t * poly
    return t * F.exp(-x * x + poly)


def two_sided_p(z: Column) -> Column:
    return erfc(F.abs(z) / math.sqrt(2))


def chi2_sf(x: float, dof: int) -> float:
    """Upper tail of chi squared: the regularised incomplete gamma function by series or by
    continued fraction."""
    if dof <= 0 or math.isnan(x):
        return math.nan
    a, x = dof / 2, max(x, 0.0) / 2
    if x == 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > abs(total) * 1e-15:
            n += 1
            term *= x / n
            total += term
        return 1 - total * front
    b = x + 1 - a
    c, d = 1e300, 1 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or 1e-300)
        c = b + an / c or 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def significant(x: Column, digits: int = 3) -> Column:
    """Rounded to significant digits."""
    scale = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(x))) - (digits - 1))
    return F.when(x == 0, 0.0).otherwise(F.round(x / scale) * scale)
