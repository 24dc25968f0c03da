"""Operators on tiles: patches are exploded to the keys of the tiles that overlap them, then handled as arrays."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def goldstein(grid: DataFrame, size: int = 32, alpha: float = 0.5) -> DataFrame:
    """Spectral phase filter over ``grid (r, c, re, im)``: half-overlapping patches, |F|**alpha weights, triangular overlap-add."""
    half = size // 2
    keys = F.explode(F.array(*[F.struct((F.floor(F.col("r") / half) - i).alias("pr"), (F.floor(F.col("c") / half) - j).alias("pc")) for i in (0, 1) for j in (0, 1)]))
    sent = grid.select("r", "c", "re", "im", keys.alias("k")).select("k.pr", "k.pc", "r", "c", "re", "im")
    rise = np.arange(half) / (half - 1)
    tri = np.concatenate([rise, rise[::-1]])  # 0 to 1 and back; neighbours' weights add up to 1

    def one(p: pd.DataFrame) -> pd.DataFrame:
        r, c = (p.r - p.pr * half).to_numpy(), (p.c - p.pc * half).to_numpy()
        z = np.zeros((size, size), complex)
        z[r, c] = p.re.fillna(0).to_numpy() + 1j * p.im.fillna(0).to_numpy()
        f = np.fft.fft2(z)
        out = np.fft.ifft2(f * np.abs(f) ** alpha) * np.outer(tri, tri)
        return pd.DataFrame({"r": p.r, "c": p.c, "re": out.real[r, c], "im": out.imag[r, c]})

    done = sent.groupBy("pr", "pc").applyInPandas(one, "r long, c long, re double, im double")
    return done.groupBy("r", "c").agg(F.sum("re").alias("re"), F.sum("im").alias("im"))


def sbas(stack: DataFrame, pairs: list[tuple[int, int, float]], days: list[float], smooth: float = 0.0) -> DataFrame:
    """Displacement increments per pixel of ``stack (pixel, intf, phase, sigma)`` by weighted least squares; any missing phase makes the pixel missing."""
    n, s = len(pairs), len(days)
    g = np.zeros((n + (s - 2 if smooth else 0), s - 1))
    for k, (a, b, _) in enumerate(pairs):
        g[k, a:b] = 1
    if smooth:
        for i in range(s - 2):
            g[n + i, i], g[n + i, i + 1] = smooth / (days[i + 1] - days[i]), -smooth / (days[i + 2] - days[i + 1])

    def one(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("intf")
        if len(p) != n or p.phase.isna().any():
            x = np.full(s - 1, np.nan)
        else:
            w = np.r_[1 / p.sigma.to_numpy(float), np.ones(len(g) - n)]
            x = np.linalg.lstsq(g * w[:, None], np.r_[p.phase.to_numpy(float), np.zeros(len(g) - n)] * w, rcond=1e-3)[0]
        total = np.r_[0, np.cumsum(x)]
        return pd.DataFrame({"pixel": p.pixel.iloc[0], "scene": np.arange(s), "disp": total})

    return stack.groupBy("pixel").applyInPandas(one, "pixel long, scene int, disp double")


def sbas_series(stack: DataFrame, pairs: list[tuple[int, int, float]], days: list[float], smooth: float = 0.0, scale: float = 4e-4, wavelength: float = 0.0311, block: int = 256) -> DataFrame:
    """(pixel, disp array, vel, dem_err, rms) of ``stack (pixel, intf, phase, sigma)``.

    Unknowns are the increments between scenes and a height error, whose column is the perpendicular baseline times
    ``scale``; rows are divided by sigma; ``smooth`` adds rows that tie neighbouring rates. Pixels are solved a block at a
    time by batched pseudo-inverses (small singular values below 1e-3 of the largest are dropped). A pixel that lacks a
    phase gets nothing.
    """
    n, s = len(pairs), len(days)
    g = np.zeros((n + (s - 2 if smooth else 0), s))
    for k, (a, b, bperp) in enumerate(pairs):
        g[k, a:b] = 1
        g[k, -1] = bperp * scale
    for i in range(s - 2 if smooth else 0):
        g[n + i, i], g[n + i, i + 1] = smooth / (days[i + 1] - days[i]), -smooth / (days[i + 2] - days[i + 1])
    t = np.asarray(days, float)

    def one(p: pd.DataFrame) -> pd.DataFrame:
        wide = p.pivot_table(index="pixel", columns="intf", values=["phase", "sigma"], aggfunc="first", dropna=False)
        phase = wide["phase"].reindex(columns=range(n)).to_numpy(float)
        sigma = wide["sigma"].reindex(columns=range(n)).to_numpy(float)
        full = ~np.isnan(phase).any(1) & ~np.isnan(sigma).any(1)
        disp, vel, dem, rms = np.full((len(wide), s), np.nan), *np.full((3, len(wide)), np.nan)
        if full.any():
            w = np.c_[1 / sigma[full], np.ones((full.sum(), len(g) - n))]
            y = np.c_[phase[full], np.zeros((full.sum(), len(g) - n))]
            x = np.einsum("pij,pj->pi", np.linalg.pinv(g[None] * w[:, :, None], rcond=1e-3), y * w)
            d = np.c_[np.zeros(len(x)), np.cumsum(x[:, :-1], 1)]
            disp[full] = d * -79.58 * wavelength
            slope = ((t - t.mean()) * (d - d.mean(1, keepdims=True))).sum(1) / ((t - t.mean()) ** 2).sum()
            vel[full], dem[full] = slope * 365 * -79.58 * wavelength, x[:, -1]
            rms[full] = np.sqrt(((y - x @ g.T)[:, :n] ** 2).mean(1))
        none = lambda v: [None if np.isnan(e) else float(e) for e in v]
        return pd.DataFrame({"pixel": wide.index, "disp": [None if np.isnan(r[0]) else r.tolist() for r in disp], "vel": none(vel), "dem_err": none(dem), "rms": none(rms)})

    return stack.withColumn("block", F.floor(F.col("pixel") / block)).groupBy("block").applyInPandas(lambda p: one(p), "pixel long, disp array<double>, vel double, dem_err double, rms double")


def tile_bounds(spark, rows: int, cols: int, size: int, overlap: int) -> DataFrame:
    """The tiles of a frame, with overlaps on their inner sides."""
    nr, nc = -(-rows // size), -(-cols // size)
    t = spark.range(nr * nc).select(F.floor(F.col("id") / nc).alias("row"), (F.col("id") % nc).alias("col"))

    def first(k: str):
        return F.col(k) * size - F.when(F.col(k) > 0, overlap).otherwise(0)

    def last(k: str, most: int):
        return F.least((F.col(k) + 1) * size + overlap, F.lit(most))

    return t.select("row", "col", first("row").alias("first_row"), last("row", rows).alias("last_row"), first("col").alias("first_col"), last("col", cols).alias("last_col"))
