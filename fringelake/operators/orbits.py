"""Orbits and geometry: state vectors, ellipsoidal coordinates, closest approach, look vectors and baselines.

An orbit has a few thousand state vectors at most, so it is one array beside the points and never a side to be shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AXIS, FLAT = 6378137.0, 1 / 298.257223563
E2 = FLAT * (2 - FLAT)


def to_xyz(lon: Column, lat: Column, height: Column) -> tuple[Column, Column, Column]:
    """Earth-centred coordinates of degrees and metres."""
    la, lo = F.radians(lat), F.radians(lon)
    n = AXIS / F.sqrt(1 - E2 * F.sin(la) * F.sin(la))
    return (n + height) * F.cos(la) * F.cos(lo), (n + height) * F.cos(la) * F.sin(lo), (n * (1 - E2) + height) * F.sin(la)


def to_geodetic(x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """Degrees and metres of Earth-centred coordinates, by the auxiliary angle."""
    b = AXIS * (1 - FLAT)
    p = F.hypot(x, y)
    u = F.atan2(z * AXIS, p * b)
    ep2 = E2 / (1 - E2)
    lat = F.atan2(z + ep2 * b * F.pow(F.sin(u), F.lit(3)), p - E2 * AXIS * F.pow(F.cos(u), F.lit(3)))
    n = AXIS / F.sqrt(1 - E2 * F.sin(lat) * F.sin(lat))
    return F.degrees(F.atan2(y, x)), F.degrees(lat), p / F.cos(lat) - n


def state_array(orbit: DataFrame) -> Column:
    """``orbit (k, t, x, y, z)`` as one array, in order."""
    return orbit.agg(F.sort_array(F.collect_list(F.struct("k", "t", "x", "y", "z"))).alias("o")).scalar()


def closest(points: DataFrame, orbit: DataFrame) -> DataFrame:
    """``points (.., px, py, pz)`` with best (d2, k, t): the state vector of least distance, the first of equal ones; and
    t0, the time at the vertex of the parabola through it and its neighbours."""
    d = points.withColumn("orbit", state_array(orbit))

    def square(o: Column) -> Column:
        return F.pow(o["x"] - F.col("px"), F.lit(2)) + F.pow(o["y"] - F.col("py"), F.lit(2)) + F.pow(o["z"] - F.col("pz"), F.lit(2))

    d = d.withColumn("ds", F.transform("orbit", lambda o: F.struct(square(o).alias("d2"), o["k"].alias("k"), o["t"].alias("t"))))
    d = d.withColumn("best", F.array_min("ds")).withColumn("at", F.array_position("ds", F.col("best")).cast("int"))
    before, after = F.get("ds", F.col("at") - 2), F.get("ds", F.col("at"))
    curve = before["d2"] - 2 * F.col("best.d2") + after["d2"]
    t0 = F.col("best.t") + F.coalesce((before["d2"] - after["d2"]) / (2 * F.nullif(curve, F.lit(0.0))) * (after["t"] - before["t"]) / 2, F.lit(0.0))
    return d.withColumn("t0", t0).drop("orbit", "ds", "at")


def east_north_up(lon: Column, lat: Column, dx: Column, dy: Column, dz: Column) -> tuple[Column, Column, Column]:
    """A vector in the local frame at a place, of length one."""
    lo, la = F.radians(lon), F.radians(lat)
    size = F.sqrt(dx * dx + dy * dy + dz * dz)
    e = -F.sin(lo) * dx + F.cos(lo) * dy
    n = -F.sin(la) * F.cos(lo) * dx - F.sin(la) * F.sin(lo) * dy + F.cos(la) * dz
    u = F.cos(la) * F.cos(lo) * dx + F.cos(la) * F.sin(lo) * dy + F.sin(la) * dz
    return e / size, n / size, u / size
