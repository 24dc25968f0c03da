"""Taper windows over x from 0 to 1, as Columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def hamming(x: Column) -> Column:
    return 0.54 - 0.46 * F.cos(2 * math.pi * x)


def cosine(x: Column) -> Column:
    return 0.5 - 0.5 * F.cos(2 * math.pi * x)


def triangle(x: Column) -> Column:
    return 1 - F.abs(2 * x - 1)


def bessel_i0(x: Column, terms: int = 16) -> Column:
    """The modified Bessel function of order zero by its series; sixteen terms serve arguments up to about ten."""
    out = F.lit(1.0)
    for k in range(1, terms):
        out = out + F.pow(x / 2, F.lit(2 * k)) / float(math.factorial(k) ** 2)
    return out


def kaiser(x: Column, beta: float) -> Column:
    side = 2 * x - 1
    return bessel_i0(beta * F.sqrt(F.greatest(F.lit(0.0), 1 - side * side))) / bessel_i0(F.lit(beta))
