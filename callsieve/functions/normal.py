"""Standard normal distribution as Columns, to double precision."""

from __future__ import annotations

from functools import reduce
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rational approximation of Hart (1968) as published by West (2005).
TOP = [3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931,
       220.206867912376]
BOTTOM = [8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831,
          793.826512519948, 440.413735824752]


def polynomial(x: Column, coefficients: list[float]) -> Column:
    return reduce(lambda done, c: done * x + c, coefficients[1:], F.lit(coefficients[0]))


def cdf(z: Column) -> Column:
    """P(Z <= z)."""
    x = F.abs(z)
    density = F.exp(-x * x / 2)
    near = density * polynomial(x, TOP) / polynomial(x, BOTTOM)
    far = density / 2.506628274631 / (x + F.lit(1.0) / (x + F.lit(2.0) / (x + F.lit(3.0) / (x + F.lit(4.0) / (x + 0.65)))))
    tail = F.when(x < 7.07106781186547, near).when(x <= 37, far).otherwise(0.0)
    return F.when(z > 0, 1 - tail).otherwise(tail)


def quantile(p: float) -> float:
    """z with P(Z <= z) = p, for plan-time constants."""
    return NormalDist().inv_cdf(p)
