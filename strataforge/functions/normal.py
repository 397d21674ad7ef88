"""The standard normal distribution in column expressions: density, upper tail and its inverse.

Spark has no error function. Near the middle the tail comes from a series whose terms are all positive, further out from
a continued fraction, so it keeps its relative precision until the density itself is too small for a double.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where the continued fraction takes over from the series, and the terms of either: enough for a double on its side.
FAR, TERMS = 2.5, 120
_NEWTON_STEPS = 6


def density(z: Column) -> Column:
    return F.exp(-z * z / 2) / math.sqrt(2 * math.pi)


def upper_tail(z: Column) -> Column:
    """P(Z > z); null for null."""
    x = F.abs(z)
    down = F.sequence(F.lit(TERMS), F.lit(1), F.lit(-1)).cast("array<double>")
    near = 0.5 - density(x) * x * F.aggregate(down, F.lit(1.0), lambda acc, k: 1 + x * x / (2 * k + 1) * acc)
    fraction = F.aggregate(down, x, lambda acc, k: x + k / acc)
    tail = F.when(x < FAR, near).otherwise(density(x) / fraction)
    return F.when(z < 0, 1 - tail).otherwise(tail)


def upper_quantile(p: Column) -> Column:
    """The z with P(Z > z) = p, for p between 0 and 1; null outside."""
    small = F.least(p, 1 - p)
    t = F.sqrt(-2 * F.log(small))
    first = t - (2.30753 + 0.27061 * t) / (1 + 0.99229 * t + 0.04481 * t * t)  # a rational start, off by 0.003 at most

    def newton(z: Column, _: Column) -> Column:
        return F.aggregate(F.array(upper_tail(z)), z, lambda at, tail: at + F.log(tail / small) * tail / density(at))

    z = F.aggregate(F.sequence(F.lit(1), F.lit(_NEWTON_STEPS)), first, newton)
    return F.when(p == 0.5, 0.0).when((p > 0) & (p < 1), F.when(p > 0.5, -z).otherwise(z))
