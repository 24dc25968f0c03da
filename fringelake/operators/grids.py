"""Operators on long grids ``(r, c, z, ...)``: selections, neighbourhoods by tiles, nearest cells, shifts, components."""

from __future__ import annotations

import math
import tempfile
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import bilinear

# --- selections --------------------------------------------------------------------------------------------------


def box_mean(cells: DataFrame, row: int, col: int, half: int) -> DataFrame:
    """One row: the mean of a box around a reference point."""
    return cells.where(F.col("r").between(row - half, row + half) & F.col("c").between(col - half, col + half)).agg(F.avg("z").alias("mean"))


def guarded(rows: DataFrame, least: int) -> DataFrame:
    """``rows`` if they are at least ``least``, else none."""
    return rows.where(rows.limit(least).agg(F.count("*")).scalar() >= least)


def with_fields(lines: DataFrame, column: str, n: int) -> DataFrame:
    return lines.where(F.size(F.split(column, " ")) == n)


def in_frame(x: Column, y: Column, width: int, height: int) -> Column:
    return (x > 0) & (x < width) & (y > 0) & (y < height)


def in_footprint(x: Column, y: Column, width: int, height: int, px: int = 10, lines: int = 20) -> Column:
    return x.between(-px, width + px) & y.between(-lines, height + lines)


def trimmed(cells: DataFrame) -> DataFrame:
    """Cells within the bounds of those that are known."""
    b = cells.where("z is not null").agg(F.struct(F.min("r").alias("r0"), F.max("r").alias("r1"), F.min("c").alias("c0"), F.max("c").alias("c1")).alias("b")).scalar()
    return cells.withColumn("_b", b).where(F.col("r").between(F.col("_b.r0"), F.col("_b.r1")) & F.col("c").between(F.col("_b.c0"), F.col("_b.c1"))).drop("_b")


def near_median(cells: DataFrame, limit: float) -> DataFrame:
    """Cells within ``limit`` of the (lower) median."""
    return cells.where(F.abs(F.col("z") - cells.agg(F.expr("percentile_disc(0.5) within group (order by z)")).scalar()) <= limit)


def earth_radius(lat: Column, a: float = 6378137.0, b: float = 6356752.314245) -> Column:
    """The ellipsoid's local radius at a latitude in degrees."""
    co, si = F.cos(F.radians(lat)), F.sin(F.radians(lat))
    return F.sqrt((F.pow(a * a * co, F.lit(2)) + F.pow(b * b * si, F.lit(2))) / (F.pow(a * co, F.lit(2)) + F.pow(b * si, F.lit(2))))


# --- fits --------------------------------------------------------------------------------------------------------


def polynomial(points: DataFrame, degree: int) -> DataFrame:
    """One row k0, k1, ...: least squares of ``points (t, y)`` by sums of powers."""
    sums = points.agg(*[F.sum(F.pow("t", F.lit(i))).alias(f"a{i}") for i in range(2 * degree + 1)], *[F.sum(F.pow("t", F.lit(i)) * F.col("y")).alias(f"b{i}") for i in range(degree + 1)]).first()
    normal = np.array([[sums[f"a{i + j}"] for j in range(degree + 1)] for i in range(degree + 1)], float)
    k = np.linalg.solve(normal, np.array([sums[f"b{i}"] for i in range(degree + 1)], float))
    return points.sparkSession.createDataFrame([tuple(map(float, k))], ", ".join(f"k{i} double" for i in range(degree + 1)))


def plane(cells: DataFrame, weight: Column | None = None) -> tuple[float, float, float]:
    """(a, b, g) of the weighted least-squares plane z = a + b r + g c, from one row of sums."""
    w = F.lit(1.0) if weight is None else weight
    names = ["1", "r", "c"]
    at = {"1": F.lit(1.0), "r": F.col("r"), "c": F.col("c")}
    known = cells.where("z is not null")
    s = known.agg(*[F.sum(w * at[x] * at[y]).alias(x + y) for x in names for y in names], *[F.sum(w * at[x] * F.col("z")).alias("z" + x) for x in names]).first()
    return tuple(np.linalg.lstsq(np.array([[s[x + y] for y in names] for x in names], float), np.array([s["z" + x] for x in names], float), rcond=None)[0].tolist())


def without_plane(cells: DataFrame) -> DataFrame:
    a, b, g = plane(cells)
    return cells.withColumn("z", F.col("z") - (F.lit(a) + F.col("r") * b + F.col("c") * g))


def robust_plane(cells: DataFrame, rounds: int = 5, width: float = 1.345) -> tuple[float, float, float]:
    """Iteratively re-weighted plane: weights fall with residuals beyond ``width`` robust deviations."""
    a, b, g = plane(cells)
    for _ in range(rounds):
        rest = F.abs(F.col("z") - (F.lit(a) + F.col("r") * b + F.col("c") * g))
        spread = cells.agg(F.percentile_approx(rest, 0.5, 100_000)).first()[0] / 0.6745 or 1e-12
        a, b, g = plane(cells, F.when(rest <= width * spread, 1.0).otherwise(width * spread / rest))
    return a, b, g


# --- neighbourhoods ----------------------------------------------------------------------------------------------


def gaussian(metres: float, row_metres: float, col_metres: float) -> list[tuple[int, int, float]]:
    """A kernel (di, dj, weight) of a Gaussian whose width at a tenth is ``metres``; odd, four deviations wide."""
    sigma = metres / 5.3
    hr, hc = (int(4 * sigma / p) // 2 for p in (row_metres, col_metres))
    return [(i, j, math.exp(-((i * row_metres) ** 2 + (j * col_metres) ** 2) / (2 * sigma * sigma))) for i in range(-hr, hr + 1) for j in range(-hc, hc + 1)]


def _tiles(at: str, tile: int, halo: int) -> Column:
    return F.explode(F.sequence(F.floor((F.col(at) - halo) / tile), F.floor((F.col(at) + halo) / tile)))


def convolved(cells: DataFrame, kernel: list[tuple[int, int, float]], down: int = 1, across: int = 1, tile: int = 256) -> DataFrame:
    """Weighted mean around every ``down``-th row's and ``across``-th column's cell, over the known cells that the kernel reaches.

    Cells go to tiles with a border as wide as the kernel, so a cell is sent once, or up to four times at a tile's edge,
    whatever the kernel's size.
    """
    hr, hc = max(abs(i) for i, _, _ in kernel), max(abs(j) for _, j, _ in kernel)
    sent = cells.where("z is not null").select("r", "c", "z", _tiles("r", tile, hr).alias("tr")).select("*", _tiles("c", tile, hc).alias("tc"))

    def one(p: pd.DataFrame) -> pd.DataFrame:
        r0, c0 = int(p.tr.iloc[0]) * tile, int(p.tc.iloc[0]) * tile
        z = np.full((tile + 2 * hr, tile + 2 * hc), np.nan)
        z[p.r.to_numpy() - r0 + hr, p.c.to_numpy() - c0 + hc] = p.z
        have = ~np.isnan(z)
        flat = np.where(have, z, 0)
        total, weight = np.zeros((2, tile, tile))
        for i, j, w in kernel:
            at = np.s_[hr + i : hr + i + tile, hc + j : hc + j + tile]
            total += w * flat[at]
            weight += w * have[at]
        r, c = np.nonzero(have[hr : hr + tile, hc : hc + tile])
        keep = ((r + r0) % down == 0) & ((c + c0) % across == 0) & (np.abs(weight[r, c]) > 1e-12)
        r, c = r[keep], c[keep]
        return pd.DataFrame({"r": (r + r0) // down, "c": (c + c0) // across, "z": total[r, c] / weight[r, c]})

    return sent.groupBy("tr", "tc").applyInPandas(one, "r long, c long, z double")


def taps(cells: DataFrame, kernel: list[tuple[int, int, float]]) -> DataFrame:
    """(r, c, z, taps): the weighted sum of a derivative kernel and how many cells it met."""
    sent = cells.select("z", F.explode(F.array(*[F.struct((F.col("r") - i).alias("r"), (F.col("c") - j).alias("c"), F.lit(w).alias("w")) for i, j, w in kernel])).alias("k"))
    found = sent.groupBy("k.r", "k.c").agg(F.sum(F.col("z") * F.col("k.w")).alias("z"), F.count("*").alias("taps"))
    return found.join(cells.select("r", "c"), ["r", "c"])


def windowed(cells: DataFrame, hr: int, hc: int, rows: tuple[int, int] = (1, 0), cols: tuple[int, int] = (1, 0), keep: list[str] | None = None) -> DataFrame:
    """Each cell once for every chosen centre (r, c) within its reach; centres are rows and columns of a remainder."""
    near = F.array(*[F.struct((F.col("r") + i).alias("r"), (F.col("c") + j).alias("c")) for i in range(-hr, hr + 1) for j in range(-hc, hc + 1)])
    near = F.filter(near, lambda k: (F.pmod(k["r"], F.lit(rows[0])) == rows[1]) & (F.pmod(k["c"], F.lit(cols[0])) == cols[1]))
    sent = cells.select("z", *[x for x in ("im",) if x in cells.columns], F.explode(near).alias("k")).select("k.r", "k.c", "z", *[x for x in ("im",) if x in cells.columns])
    return sent.join(cells.select("r", "c", *[F.col("z").alias(x) for x in keep or []]), ["r", "c"])


# --- nearest -----------------------------------------------------------------------------------------------------


def nearest(points: DataFrame, known: DataFrame, cell: int, extent: float) -> DataFrame:
    """For ``points (pr, pc)`` the nearest of ``known (r, c, z)``, ties by row and column: (pr, pc, best (d2, r, c, z)).

    Buckets of ``cell`` cells are joined with their eight neighbours; a point whose best is nearer than anything beyond
    them can be is settled, the others go on with buckets twice as wide, until ``extent`` is reached.
    """
    out, rest = None, points
    while True:
        k = known.select("r", "c", "z", F.floor(F.col("r") / cell).alias("br"), F.floor(F.col("c") / cell).alias("bc"))
        around = F.explode(F.array(*[F.struct((F.floor(F.col("pr") / cell) + i).alias("br"), (F.floor(F.col("pc") / cell) + j).alias("bc")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
        near = rest.select("pr", "pc", around.alias("b")).select("pr", "pc", "b.br", "b.bc").join(k, ["br", "bc"], "left")
        d2 = F.pow(F.col("pr") - F.col("r"), F.lit(2)) + F.pow(F.col("pc") - F.col("c"), F.lit(2))
        best = near.groupBy("pr", "pc").agg(F.min(F.when(F.col("z").isNotNull(), F.struct(d2.alias("d2"), "r", "c", "z"))).alias("best"))
        last = cell >= extent
        settled = F.lit(True) if last else F.coalesce(F.col("best.d2") <= cell * cell, F.lit(False))
        out = best.where(settled) if out is None else out.union(best.where(settled))
        if last:
            return out
        rest, cell = best.where(~settled).select("pr", "pc"), cell * 2


def nearest_fill(cells: DataFrame, cell: int = 16, radius: float | None = None) -> DataFrame:
    """``cells (r, c, z)`` with unknown ones filled by the nearest known one within ``radius``; without it, at any distance."""
    if radius is None:
        b = cells.agg(F.max("r") - F.min("r"), F.max("c") - F.min("c")).first()
        extent = float(max(b[0] or 0, b[1] or 0) + 1)
    else:
        extent = radius
    best = nearest(cells.where("z is null").select(F.col("r").alias("pr"), F.col("c").alias("pc")), cells.where("z is not null"), cell, extent)
    z = F.when(F.col("best.d2") <= radius * radius + 1e-9, F.col("best.z")) if radius is not None else F.col("best.z")
    return cells.where("z is not null").select("r", "c", "z").union(best.select(F.col("pr"), F.col("pc"), z))


# --- shifts, resampling, components ------------------------------------------------------------------------------


def best_shift(a: DataFrame, b: DataFrame, reach: int, block: int) -> DataFrame:
    """Per block of ``a`` the shift of ``b`` with the highest normalised correlation; the first in scan order of equal ones."""
    shifts = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-reach, reach + 1) for j in range(-reach, reach + 1)]))
    sent = a.select(F.floor(F.col("r") / block).alias("br"), F.floor(F.col("c") / block).alias("bc"), "r", "c", F.col("z").alias("x"), shifts.alias("s"))
    sent = sent.select("br", "bc", "x", "s", (F.col("r") + F.col("s.i")).alias("r"), (F.col("c") + F.col("s.j")).alias("c"))
    met = sent.join(b.select("r", "c", F.col("z").alias("y")), ["r", "c"])
    corr = 100 * F.abs(F.sum(F.col("x") * F.col("y"))) / F.sqrt(F.sum(F.col("x") * F.col("x")) * F.sum(F.col("y") * F.col("y")))
    each = met.groupBy("br", "bc", "s").agg(corr.alias("corr"))
    best = each.groupBy("br", "bc").agg(F.max_by(F.struct("s", "corr"), F.struct("corr", -F.col("s.i"), -F.col("s.j"))).alias("b"))
    return best.select("br", "bc", F.col("b.s.i").alias("dr"), F.col("b.s.j").alias("dc"), F.col("b.corr").alias("corr"))


def upsampled(cells: DataFrame, factor: int) -> DataFrame:
    """Every cell's place at 1/``factor`` of its row and column, bilinear; where a neighbour is missing, nothing."""
    width = 1 << 32
    points = cells.select((F.col("r") * width + F.col("c")).alias("pid"), (F.col("r") / factor).alias("y"), (F.col("c") / factor).alias("x"))
    return bilinear(points, cells.select("r", "c", "z")).where("z is not null").select(F.floor(F.col("pid") / width).alias("r"), (F.col("pid") % width).alias("c"), "z")


def _cut(df: DataFrame) -> DataFrame:
    """``df`` as a table in the folder that the session names as shared; in local mode without one, in a folder of its own."""
    spark = df.sparkSession
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="fringelake-")
    path = f"{path.rstrip('/')}/grid-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def largest_components(nodes: DataFrame, least: int) -> DataFrame:
    """(root, size, rank) of the 4-connected components of ``nodes (k, r, c)`` with ``least`` nodes or more, largest first.

    Labels are roots: all nodes of a root take the least label that any of them or their neighbours has, and the labels of
    labels follow, so chains of components shrink by a factor in each round.
    """
    nodes = _cut(nodes)
    steps = F.explode(F.array(*[F.struct((F.col("r") + i).alias("r"), (F.col("c") + j).alias("c")) for i, j in ((0, 1), (1, 0), (0, -1), (-1, 0))]))
    edges = nodes.select(F.col("k").alias("a"), steps.alias("s")).select("a", "s.r", "s.c").join(nodes.select(F.col("k").alias("b"), "r", "c"), ["r", "c"]).select("a", "b")
    edges = _cut(edges)
    label = nodes.select("k", F.col("k").alias("l"))
    while True:
        near = edges.join(label.select(F.col("k").alias("b"), F.col("l").alias("m")), "b").groupBy(F.col("a").alias("k")).agg(F.min("m").alias("m"))
        low = label.join(near, "k", "left").select("l", F.least("l", F.coalesce("m", "l")).alias("n"))
        hook = _cut(low.groupBy("l").agg(F.min("n").alias("h")))  # one row a root
        if hook.where("h <> l").isEmpty():
            break
        to = hook.join(hook.select(F.col("l").alias("h"), F.col("h").alias("h2")), "h", "left").select("l", F.least("h", F.coalesce("h2", "h")).alias("new"))
        label = _cut(label.join(to, "l").select("k", F.col("new").alias("l")))
    sizes = label.groupBy(F.col("l").alias("root")).agg(F.count("*").alias("size")).where(F.col("size") >= least)
    return sizes.select("root", "size", F.row_number().over(Window.orderBy(F.desc("size"), "root")).alias("rank"))
