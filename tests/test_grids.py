"""Grid, orbit and network operators against plain versions and closed forms."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fringelake.functions.rpn import compile_rpn
from fringelake.operators import grids, joins, orbits, tiles
from fringelake.plans import queries as Q

SF = "/root/testdata/sf0.001"


def grid(spark, z):
    return spark.createDataFrame([(i, j, None if np.isnan(z[i, j]) else float(z[i, j])) for i in range(z.shape[0]) for j in range(z.shape[1])], "r long, c long, z double")


def test_nearest_fill_with_far_holes(spark):
    rng = np.random.default_rng(1)
    z = np.where(rng.random((40, 30)) < 0.02, rng.random((40, 30)), np.nan)
    known = [(i, j) for i in range(40) for j in range(30) if not np.isnan(z[i, j])]
    got = {(r.r, r.c): r.z for r in grids.nearest_fill(grid(spark, z), 2).collect()}
    near = {(r.r, r.c): r.z for r in grids.nearest_fill(grid(spark, z), 2, radius=3).collect()}
    assert len(got) == len(near) == 1200
    for i in range(40):
        for j in range(30):
            d, a, b = min(((i - a) ** 2 + (j - b) ** 2, a, b) for a, b in known)
            assert got[i, j] == z[a, b] and near[i, j] == (z[a, b] if d <= 9 else None)


def test_convolution_across_tiles(spark):
    rng = np.random.default_rng(2)
    z = np.where(rng.random((37, 23)) < 0.9, rng.random((37, 23)), np.nan)
    kernel = grids.gaussian(60, 9.0, 11.0)
    got = {(r.r, r.c): r.z for r in grids.convolved(grid(spark, z), kernel, 2, 3, tile=8).collect()}
    for i in range(0, 37, 2):
        for j in range(0, 23, 3):
            near = [(w, z[i + a, j + b]) for a, b, w in kernel if 0 <= i + a < 37 and 0 <= j + b < 23 and not np.isnan(z[i + a, j + b])]
            if not np.isnan(z[i, j]):
                assert got[i // 2, j // 3] == pytest.approx(sum(w * x for w, x in near) / sum(w for w, _ in near))


def test_components_of_a_snake(spark):
    cells = [(i, j) for i in range(0, 21, 2) for j in range(20)] + [(i, 0 if i // 2 % 2 else 19) for i in range(1, 20, 2)] + [(40, 40), (40, 41), (50, 3)]
    got = grids.largest_components(spark.createDataFrame([(i * 100 + j, i, j) for i, j in cells], "k long, r long, c long"), 2).collect()
    assert [(r.root, r.size, r["rank"]) for r in got] == [(0, 230, 1), (4040, 2, 2)]


def test_robust_plane_leaves_outliers_out(spark):
    z = np.fromfunction(lambda i, j: 2 + 0.5 * i - 0.25 * j, (12, 12))
    z[3, 4], z[9, 1], z[5, 5] = 100, -80, np.nan
    assert grids.robust_plane(grid(spark, z), rounds=25) == pytest.approx((2, 0.5, -0.25), abs=1e-2)


def test_closest_approach_between_vectors(spark):
    o = spark.createDataFrame([(k, 10.0 * k, 1000.0 * k, 50.0, 0.0) for k in range(20)], "k long, t double, x double, y double, z double")
    p = spark.createDataFrame([(1, 7300.0, 0.0, 0.0), (2, -5.0, 0.0, 0.0)], "id long, px double, py double, pz double")
    got = {r.id: (r.best.k, r.t0) for r in orbits.closest(p, o).collect()}
    assert got[1] == (7, pytest.approx(73.0)) and got[2] == (0, 0.0)


def test_geodetic_poles_and_heights(spark):
    p = spark.createDataFrame([(0.0, 90.0, 10.0), (-120.0, -45.5, 8000.0), (179.9, 0.0, 0.0)], "lon double, lat double, h double")
    x, y, z = orbits.to_xyz(F.col("lon"), F.col("lat"), F.col("h"))
    lon, lat, h = orbits.to_geodetic(F.col("x"), F.col("y"), F.col("z"))
    for r in p.select("*", x.alias("x"), y.alias("y"), z.alias("z")).select("*", lon.alias("lon2"), lat.alias("lat2"), h.alias("h2")).collect()[1:]:
        assert (r.lon2, r.lat2, r.h2) == (pytest.approx(r.lon), pytest.approx(r.lat, abs=1e-8), pytest.approx(r.h, abs=1e-3))


def test_expressions(spark):
    d = spark.createDataFrame([(3.0, 4.0), (None, 2.0)], "a double, b double")
    got = d.select(compile_rpn("a b HYPOT", ["a", "b"]).alias("x"), compile_rpn("a 7 DENAN b ADD", ["a", "b"]).alias("y"), compile_rpn("b DUP MUL 3 NAN", ["a", "b"]).alias("z"), compile_rpn("a ISNAN", ["a"]).alias("n")).collect()
    assert [tuple(r) for r in got] == [(5.0, 7.0, 16.0, 0.0), (None, 9.0, 4.0, 1.0)]
    for bad in ("a ADD", "a b", "a what"):
        with pytest.raises(ValueError):
            compile_rpn(bad, ["a", "b"])


def test_series_against_one_pixel_at_a_time(spark):
    pairs, days, scale = [(0, 1, 30.0), (1, 2, -20.0), (0, 2, 10.0), (2, 3, 5.0), (1, 3, -15.0)], [0.0, 12.0, 24.0, 48.0], 4e-4
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for p in range(5):
        phase, sigma = rng.normal(size=5), rng.uniform(0.5, 2, 5)
        rows += [(p, k, float(phase[k]), float(sigma[k])) for k in range(5)]
        g = np.zeros((7, 4))
        for k, (a, b, bp) in enumerate(pairs):
            g[k, a:b], g[k, 3] = 1, bp * scale
        g[5, 0], g[5, 1], g[6, 1], g[6, 2] = 1 / 12, -1 / 12, 1 / 12, -1 / 24
        w = np.r_[1 / sigma, 1, 1]
        x = np.linalg.lstsq(g * w[:, None], np.r_[phase, 0, 0] * w, rcond=1e-3)[0]
        d = np.r_[0, np.cumsum(x[:3])]
        want[p] = (d * -79.58 * 0.0311, np.polyfit(days, d, 1)[0] * 365 * -79.58 * 0.0311, x[3], np.sqrt(((phase - (g @ x)[:5]) ** 2).mean()))
    rows += [(9, k, None if k == 2 else 1.0, 1.0) for k in range(5)]
    got = {r.pixel: r for r in tiles.sbas_series(spark.createDataFrame(rows, "pixel long, intf int, phase double, sigma double"), pairs, days, smooth=1.0).collect()}
    assert got[9].disp is None and got[9].vel is None
    for p, (d, v, h, e) in want.items():
        assert got[p].disp == pytest.approx(d.tolist()) and (got[p].vel, got[p].dem_err, got[p].rms) == (pytest.approx(v), pytest.approx(h, abs=1e-9), pytest.approx(e))


def test_series_query_covers_every_pixel(spark):
    got = Q.queries()["sbas_series"](spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/lineitem.parquet").select("l_partkey").distinct().count()
    full = spark.read.parquet(f"{SF}/lineitem.parquet").groupBy("l_partkey").agg(F.countDistinct("l_linenumber").alias("n")).where("n = 7").count()
    assert sum(r.vel is not None for r in got) == full


def test_time_symmetric_couples(spark):
    p = spark.createDataFrame([(1, 2, 0, 12), (2, 3, 12, 24), (3, 4, 24, 60), (5, 6, 0, 90)], "ref long, rep long, d1 int, d2 int")
    assert {(r.ref, r.rep) for r in joins.symmetric_both(p).collect()} == {(1, 2), (2, 3)}


def test_goldstein_against_plain_patches(spark):
    rng = np.random.default_rng(7)
    phase = np.cumsum(rng.normal(0, 0.3, (64, 64)), 1)
    z = np.exp(1j * phase)
    rise = np.arange(16) / 15
    w = np.outer(*[np.r_[rise, rise[::-1]]] * 2)
    want = np.zeros((64 + 32, 64 + 32), complex)
    pad = np.zeros((96, 96), complex)
    pad[16:80, 16:80] = z
    for i in range(0, 65, 16):
        for j in range(0, 65, 16):
            f = np.fft.fft2(pad[i : i + 32, j : j + 32])
            want[i : i + 32, j : j + 32] += np.fft.ifft2(f * np.abs(f) ** 0.5) * w
    d = spark.createDataFrame([(i, j, float(z[i, j].real), float(z[i, j].imag)) for i in range(64) for j in range(64)], "r long, c long, re double, im double")
    got = tiles.goldstein(d).toPandas()
    assert np.allclose(got.re + 1j * got.im, want[16:80, 16:80][got.r, got.c], atol=1e-8)


def test_geometry_of_the_projected_look(spark):
    e, n, u = (x.alias(k) for x, k in zip(orbits.east_north_up(F.lit(0.0), F.lit(0.0), F.lit(2.0), F.lit(0.0), F.lit(0.0)), "enu"))
    r = spark.range(1).select(e, n, u).first()
    assert (r.e, r.n, r.u) == (pytest.approx(0), pytest.approx(0), pytest.approx(1)) and math.isclose(orbits.E2, 0.00669438, rel_tol=1e-6)


def test_exact_ranks_without_ordering(spark, monkeypatch):
    from fringelake.operators import stats

    monkeypatch.setattr(stats, "HELD", 50)
    rng = np.random.default_rng(4)
    x = np.r_[rng.normal(size=4000), np.zeros(3000), np.repeat(7.5, 500)]
    d = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "v double")
    ranks = [1, 2000, 3500, 5000, 7100, 7500]
    assert stats.at_ranks(d, "v", ranks) == np.sort(x)[np.array(ranks) - 1].tolist()
    assert stats.upper_median(d, "v").first()[0] == np.sort(x)[3750]
    assert stats.iqr_bounds(d.limit(0), "v").first().q1 is None and stats.mad_bounds(d.where("v = 7.5"), "v").first().mad == 0.0


def test_kernel_queries_against_closed_forms(spark):
    got = Q.queries()["orbit_interpolated"](spark, "/root/testdata/sf0.01").toPandas()
    a = 0.0105 * (got.t - 86400 * 3 - 500) / 10
    assert len(got) > 900 and np.abs(got.x - 7071000 * np.cos(a) * np.cos(0.2)).max() < 1e-3 and np.abs(got.z - 7071000 * np.sin(a)).max() < 1e-3
    cells = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").groupBy((F.col("l_orderkey") % 64).alias("r"), (F.col("l_partkey") % 64).alias("c")).agg((F.avg("l_extendedprice") / 9973.0).alias("z")).toPandas()
    known = {(r, c): z for r, c, z in cells.itertuples(index=False)}
    knots = Q.queries()["row_spline"](spark, "/root/testdata/sf0.01").where("at = floor(at)").collect()
    assert len(knots) > 3000 and all(r.z == pytest.approx(known[r.r, int(r.at)]) for r in knots if (r.r, int(r.at)) in known)
    fine = Q.queries()["oversampled_rows"](spark, "/root/testdata/sf0.01").where("k % 4 = 0 and r = 5").orderBy("k").toPandas()
    row = [known[k] for k in sorted(known) if k[0] == 5]
    assert np.allclose(fine.re, row)
    b = Q.queries()["split_bands"](spark, "/root/testdata/sf0.01").where("r = 5").toPandas()
    assert len(b) == len(row)
