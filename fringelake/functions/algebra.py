"""Grid algebra as Column expressions. Missing cells are NULL; NaN is turned into NULL where data come in."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_PI = 2 * math.pi


def missing(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def amplitude(re: Column, im: Column) -> Column:
    return F.sqrt(re * re + im * im)


def phase(re: Column, im: Column) -> Column:
    return F.atan2(im, re)


def wrap(phi: Column) -> Column:
    return F.pmod(phi + math.pi, F.lit(TWO_PI)) - math.pi


def clip_high(x: Column, top: float) -> Column:
    return F.when(x.isNotNull(), F.least(x, F.lit(top)))


def clip_low(x: Column, low: float) -> Column:
    return F.when(x.isNotNull(), F.greatest(x, F.lit(low)))


def at_least(x: Column, bound: float) -> Column:
    """1 or 0; NULL where x is missing."""
    return F.when(x >= bound, 1.0).when(x < bound, 0.0)


def mask_value(x: Column, value: float) -> Column:
    return F.nullif(x, F.lit(value))


def fill(a: Column, b: Column) -> Column:
    return F.coalesce(a, b)


def masked_by(a: Column, b: Column) -> Column:
    return F.when(b.isNotNull(), a)


def sigma(coherence: Column) -> Column:
    """Phase noise of a coherence; bounds 0.01 and 0.99 have fixed values, missing counts as coherent."""
    return F.when(coherence < 0.01, 99.99).when(coherence > 0.99, 0.1).when(coherence.isNull(), 0.1).otherwise(F.sqrt((1 - coherence * coherence) / (coherence * coherence)))


def los_mm(phi: Column, wavelength: float) -> Column:
    return phi * (wavelength / (-4 * math.pi) * 1000)


def los_m(phi: Column, wavelength: float = 0.0555) -> Column:
    return phi * (wavelength / (4 * math.pi))


def split_spectrum(low: Column, high: Column, f_low: float, f_high: float, f_centre: float) -> Column:
    return (low * (f_high / f_centre) - high * (f_low / f_centre)) * (f_low * f_high / (f_high**2 - f_low**2))


def delay_phase(delay: Column, wavelength: float, look_deg: Column) -> Column:
    return delay * (4 * math.pi / wavelength) / F.cos(F.radians(look_deg))


def project(e: Column, n: Column, u: Column, ve: Column, vn: Column, vu: Column) -> Column:
    return ve * e + vn * n + vu * u


def times_conj(ar: Column, ai: Column, br: Column, bi: Column) -> tuple[Column, Column]:
    return ar * br + ai * bi, ai * br - ar * bi


def flip(row: Column, n_rows: int) -> Column:
    return F.lit(n_rows - 1) - row


# --- masks and comparisons: 1, 0, or missing where either side is missing -----------------------------------------


def compared(a: Column, op: str, b: Column) -> Column:
    """``op``: ge, le, gt, lt or eq."""
    test = {"ge": a >= b, "le": a <= b, "gt": a > b, "lt": a < b, "eq": a == b}[op]
    return test.cast("double")


def either(a: Column, b: Column) -> Column:
    """``a`` where it is known, else ``b``."""
    return F.coalesce(a, b)


def fraction_of(re: Column, im: Column, power: Column) -> Column:
    """Coherence of a complex product over the square root of two powers' product; missing where that is next to nothing."""
    return F.when(power >= 5e-21, F.hypot(re, im) / F.sqrt(power))


def cosd(degrees: Column) -> Column:
    return F.cos(F.radians(degrees))


def product(re: Column, im: Column, re2: Column, im2: Column) -> tuple[Column, Column]:
    return re * re2 - im * im2, re * im2 + im * re2


def mai_phase(fr: Column, fi: Column, br: Column, bi: Column, separation: float, prf: float, pixel: float) -> Column:
    """Along-track displacement from the forward and backward looks' interferograms."""
    re, im = product(fr, fi, br, -bi)
    return F.atan2(im * 3e5, re * 3e5) / (2 * math.pi * separation * prf) * pixel
