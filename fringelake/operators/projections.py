"""Between radar and map coordinates: lookup grids, gathers, resampling by an affine map, transverse Mercator."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .orbits import AXIS, E2

#: A lookup grid's linear part: degrees a column and a row, from a corner.
CORNER, LON, LAT = (35.0, 100.0), (0.011, 0.0007), (0.009, -0.0005)


def split_shift(shift: float) -> tuple[int, float]:
    """A shift as a whole number and a fraction that is not negative."""
    whole = math.trunc(shift)
    return (whole - 1, shift - whole + 1) if shift < 0 else (whole, shift - whole)


def short(x: Column) -> Column:
    """Rounded half up, and held within 16 bits."""
    return F.least(F.greatest(F.floor(x + 0.5), F.lit(-32768)), F.lit(32767)).cast("int")


def nearest_sample(points: DataFrame, cells: DataFrame) -> DataFrame:
    """``points (r, c, y, x)`` with z of the cell nearest (y, x); nothing outside the frame."""
    at = points.select("r", "c", F.floor(F.col("y") + 0.5).alias("kr"), F.floor(F.col("x") + 0.5).alias("kc"))
    return at.join(cells.select(F.col("r").alias("kr"), F.col("c").alias("kc"), "z"), ["kr", "kc"], "left").select("r", "c", "z")


def to_map(cells: DataFrame, south: float, west: float, step: float) -> DataFrame:
    """``cells`` with the row and column of the map cell that the lookup grid puts them in."""
    lat = CORNER[0] + F.col("r") * LAT[0] + F.col("c") * LAT[1]
    lon = CORNER[1] + F.col("c") * LON[0] + F.col("r") * LON[1]
    return cells.withColumns({"row": F.floor((lat - south) / step), "col": F.floor((lon - west) / step)})


def to_radar(cells: DataFrame) -> DataFrame:
    """Through the lookup grid to the map and back: the inverse of its linear part."""
    dy = F.col("r") * LAT[0] + F.col("c") * LAT[1]
    dx = F.col("c") * LON[0] + F.col("r") * LON[1]
    det = LAT[0] * LON[0] - LAT[1] * LON[1]
    return cells.select(F.round((dy * LON[0] - dx * LAT[1]) / det).cast("long").alias("r"), F.round((dx * LAT[0] - dy * LON[1]) / det).cast("long").alias("c"), "z")


def utm(lat: Column, from_meridian: Column, scale: float = 0.9996) -> tuple[Column, Column]:
    """Easting and northing of degrees, by the series of the transverse Mercator projection."""
    la, dl = F.radians(lat), F.radians(from_meridian)
    ep = E2 / (1 - E2)
    n = AXIS / F.sqrt(1 - E2 * F.pow(F.sin(la), F.lit(2)))
    t, q, a = F.pow(F.tan(la), F.lit(2)), ep * F.pow(F.cos(la), F.lit(2)), F.cos(la) * dl
    arc = (1 - E2 / 4 - 3 * E2**2 / 64 - 5 * E2**3 / 256) * la - (3 * E2 / 8 + 3 * E2**2 / 32 + 45 * E2**3 / 1024) * F.sin(2 * la)
    arc = arc + (15 * E2**2 / 256 + 45 * E2**3 / 1024) * F.sin(4 * la) - 35 * E2**3 / 3072 * F.sin(6 * la)

    def p(k: int) -> Column:
        return F.pow(a, F.lit(k))

    east = 500000 + scale * n * (a + (1 - t + q) * p(3) / 6 + (5 - 18 * t + t * t + 72 * q - 58 * ep) * p(5) / 120)
    north = scale * (AXIS * arc + n * F.tan(la) * (p(2) / 2 + (5 - t + 9 * q + 4 * q * q) * p(4) / 24 + (61 - 58 * t + t * t + 600 * q - 330 * ep) * p(6) / 720))
    return east, north
