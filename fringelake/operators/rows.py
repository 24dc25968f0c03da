"""Operators along a row of samples, as array kernels: splines, Hermite orbits, spectra. A group is one row or one orbit."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def spline_second(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Second derivatives of the natural cubic spline, by the tridiagonal system's solution."""
    n = len(x)
    if n < 3:
        return np.zeros(n)
    h = np.diff(x)
    a = np.diag(2 * (h[:-1] + h[1:])) + np.diag(h[1:-1], 1) + np.diag(h[1:-1], -1)
    return np.r_[0, np.linalg.solve(a, 6 * np.diff(np.diff(y) / h)), 0]


def spline(x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    m, k = spline_second(x, y), np.clip(np.searchsorted(x, at, "right") - 1, 0, len(x) - 2)
    h = x[k + 1] - x[k]
    a, b = (x[k + 1] - at) / h, (at - x[k]) / h
    return a * y[k] + b * y[k + 1] + ((a**3 - a) * m[k] + (b**3 - b) * m[k + 1]) * h * h / 6


def hermite(t: np.ndarray, y: np.ndarray, v: np.ndarray, at: np.ndarray, points: int = 6) -> np.ndarray:
    """Values at ``at`` of the polynomial through the ``points`` nearest states and their rates; outside the states an error."""
    if len(t) < points or at.min() < t[0] or at.max() > t[-1]:
        raise ValueError("times outside the state vectors")
    out = np.empty(len(at))
    first = np.clip(np.searchsorted(t, at) - points // 2, 0, len(t) - points)
    for k in np.unique(first):
        here, z = first == k, np.repeat(t[k : k + points], 2)
        table = np.repeat(y[k : k + points], 2).astype(float)
        coefficient = [table[0]]
        for order in range(1, 2 * points):  # divided differences over doubled nodes
            gap = z[order:] - z[:-order]
            diff = np.diff(table)
            table = np.where(gap == 0, np.repeat(v[k : k + points], 2)[: len(gap)], diff / np.where(gap == 0, 1, gap))
            coefficient.append(table[0])
        value = np.full(here.sum(), coefficient[-1])
        for c, node in zip(coefficient[-2::-1], z[-2::-1], strict=True):
            value = value * (at[here] - node) + c
        out[here] = value
    return out


def fft_interpolated(z: np.ndarray, factor: int) -> np.ndarray:
    """``z`` at ``factor`` times as many places, by zeros in the middle of its spectrum."""
    n = len(z)
    f, out = np.fft.fft(z), np.zeros(n * factor, complex)
    out[: (n + 1) // 2], out[-(n // 2) :] = f[: (n + 1) // 2], f[-(n // 2) :]
    if n % 2 == 0:
        out[n // 2] = out[-(n // 2)] = f[n // 2] / 2
    return np.fft.ifft(out) * factor


def band(z: np.ndarray, low: float, high: float) -> np.ndarray:
    """The part of a complex row between two frequencies (of the sampling rate, -0.5 to 0.5), moved to zero."""
    n = len(z)
    k = np.fft.fftfreq(n)
    f = np.where((k >= low) & (k < high), np.fft.fft(z), 0)
    return np.fft.ifft(np.roll(f, -round((low + high) / 2 * n)))


def by_row(rows: DataFrame, kernel, by: str, order: str, columns: list[str], out: str) -> DataFrame:
    """``kernel`` of each group's columns as arrays, ordered; it returns a dict of arrays."""

    def one(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(order)
        made = kernel(*[p[c].to_numpy() for c in columns])
        return pd.DataFrame({by: p[by].iloc[0], **made})

    return rows.groupBy(by).applyInPandas(one, out)
