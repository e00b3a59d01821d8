"""Gamma-function expressions for Spark columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SHIFT = 6


def digamma(x: Column) -> Column:
    """psi(x) for x > 0: asymptotic series at x + 6, brought back by psi(x) = psi(x + 1) - 1/x."""
    y = x + F.lit(float(SHIFT))
    q = F.lit(1.0) / (y * y)
    series = q * (1 / 12 - q * (1 / 120 - q * (1 / 252 - q * (1 / 240 - q * F.lit(1 / 132)))))
    back = sum((F.lit(1.0) / (x + F.lit(float(i))) for i in range(1, SHIFT)), F.lit(1.0) / x)
    return F.ln(y) - F.lit(0.5) / y - series - back


def gammaln(x: Column) -> Column:
    """ln Gamma(x) for x > 0 by Stirling's series at x + 6."""
    y = x + F.lit(float(SHIFT))
    q = F.lit(1.0) / (y * y)
    series = (1 / 12 - q * (1 / 360 - q * (1 / 1260 - q * (1 / 1680 - q * F.lit(1 / 1188))))) / y
    prod = x
    for i in range(1, SHIFT):
        prod = prod * (x + F.lit(float(i)))
    return (y - F.lit(0.5)) * F.ln(y) - y + F.lit(0.5 * math.log(2 * math.pi)) + series - F.ln(prod)


def array_sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v)


def logsumexp(a: Column) -> Column:
    """log(sum(exp(a))) of an array, shifted by its largest entry."""
    m = F.array_max(a)
    return m + F.ln(array_sum(F.transform(a, lambda v: F.exp(v - m))))


def gamma_mean(shape: Column, rate: Column) -> Column:
    return F.zip_with(shape, rate, lambda s, r: s / r)


def gamma_geo_mean(shape: Column, rate: Column) -> Column:
    """exp(psi(shape)) / rate, element by element."""
    return F.zip_with(shape, rate, lambda s, r: F.exp(digamma(s)) / r)


def dot(a: Column, b: Column) -> Column:
    return array_sum(F.zip_with(a, b, lambda x, y: x * y))
