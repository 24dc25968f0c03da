"""Queries that run array kernels along rows, orbits or fits; SQL has no form for them, tests hold them against closed forms."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..operators import grids, rows
from .networks import _orbit
from .queries import query


@query(None)
def row_spline(v):
    """Natural cubic splines along the rows of a grid, at half columns."""

    def kernel(c, z):
        if len(c) < 2:
            return {"at": np.zeros(0), "z": np.zeros(0)}
        at = np.arange(c[0], c[-1], 0.5)
        return {"at": at, "z": rows.spline(c.astype(float), z, at)}

    return rows.by_row(v.cells().select("r", "c", "z"), kernel, "r", "c", ["c", "z"], "r long, at double, z double")


@query(None)
def orbit_interpolated(v):
    """State vectors every second, by Hermite polynomials through six of them and their rates."""
    k = F.col("k")
    speed = 0.0105 / 10
    orbit = _orbit(v).select(F.lit(0).alias("scene"), "k", "t", "x", "y", "z", (-7071000 * F.sin(0.0105 * k) * float(np.cos(0.2)) * speed).alias("vx"), (-7071000 * F.sin(0.0105 * k) * float(np.sin(0.2)) * speed).alias("vy"), (7071000 * F.cos(0.0105 * k) * speed).alias("vz"))

    def kernel(t, x, y, z, vx, vy, vz):
        if len(t) < 6:
            return {n: np.zeros(0) for n in ("t", "x", "y", "z")}
        at = np.arange(t[0], t[-1] + 0.5)
        return {"t": at, **{n: rows.hermite(t, p, s, at) for n, p, s in (("x", x, vx), ("y", y, vy), ("z", z, vz))}}

    return rows.by_row(orbit, kernel, "scene", "k", ["t", "x", "y", "z", "vx", "vy", "vz"], "scene int, t double, x double, y double, z double")


@query(None)
def split_bands(v):
    """Lower and upper halves of each row's spectrum, moved to zero."""

    def kernel(c, re, im):
        z = re + 1j * im
        low, high = rows.band(z, -0.5, 0.0), rows.band(z, 0.0, 0.5)
        return {"c": c, "low_re": low.real, "low_im": low.imag, "high_re": high.real, "high_im": high.imag}

    return rows.by_row(v.cells(), kernel, "r", "c", ["c", "z", "im"], "r long, c long, low_re double, low_im double, high_re double, high_im double")


@query(None)
def oversampled_rows(v):
    """Rows at four times as many places, by their spectra."""

    def kernel(c, re, im):
        z = rows.fft_interpolated(re + 1j * im, 4)
        return {"k": np.arange(len(z)), "re": z.real, "im": z.imag}

    return rows.by_row(v.cells(), kernel, "r", "c", ["c", "z", "im"], "r long, k long, re double, im double")


@query(None)
def robust_trend(v):
    """The plane of a grid by iterative re-weighting."""
    a, b, g = grids.robust_plane(v.cells())
    return v.spark.createDataFrame([(a, b, g)], "a double, b double, g double")
