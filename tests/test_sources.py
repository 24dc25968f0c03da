"""Readers, writers, row kernels, chains and streams on small made-up files."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from fringelake.operators import projections, rows
from fringelake.plans import stages
from fringelake.sources import binary, params
from fringelake.sources.datasource import ImageSource, pairs_function


def test_fixed_records_and_images(spark, tmp_path):
    t = np.arange(20.0).reshape(4, 5)
    (tmp_path / "trans.dat").write_bytes(t.astype("<f8").tobytes())
    got = binary.read_transform(spark, str(tmp_path / "trans.dat")).orderBy("i").collect()
    assert [[r.rng, r.azi, r.topo, r.lon, r.lat] for r in got] == t.tolist()
    z = np.random.default_rng(1).integers(-300, 300, (5, 7, 2)).astype("<i2")
    (tmp_path / "a.SLC").write_bytes(z.tobytes())
    img = {(r.r, r.c): (r.re, r.im) for r in binary.read_image(spark, str(tmp_path / "a.SLC"), 7).collect()}
    assert img == {(i, j): tuple(z[i, j].tolist()) for i in range(5) for j in range(7)}
    spark.dataSource.register(ImageSource)
    own = spark.read.format("slc").option("width", 7).option("rows", 5).option("band", 2).load(str(tmp_path / "a.SLC"))
    assert {(r.r, r.c): (r.re, r.im) for r in own.collect()} == img
    lines = b"".join(b"PREFIX__" + struct.pack(">ihB", k, -k, k) for k in range(6))
    (tmp_path / "ceos").write_bytes(b"head" + lines)
    rec = binary.fixed_records(spark, str(tmp_path / "ceos"), [("n", "i4"), ("v", "i2"), ("f", "u1")], ["n", "f"], skip=4, prefix=8, order=">").collect()
    assert [(r.n, r.f) for r in rec] == [(k, k) for k in range(6)] and "v" not in rec[0]


def test_tiff_both_ways(spark, tmp_path):
    z = np.random.default_rng(2).random((6, 9)).astype("<f4").astype(float)
    z[2, 3] = np.nan
    back = binary.tiff_pixels(binary.tiff_bytes(z))
    assert back[2, 3] == -9999 and np.allclose(np.delete(back.ravel(), 21), np.delete(z.ravel(), 21))
    pairs = np.arange(4 * 10 * 2).reshape(4, 10, 2).astype("<i2")
    strips = [pairs[:2].tobytes(), pairs[2:].tobytes()]
    entries = [(256, 3, 1, 10), (257, 3, 1, 4), (258, 3, 1, 32), (259, 3, 1, 1), (273, 4, 2, 200), (277, 3, 1, 1), (279, 4, 2, 208), (339, 3, 1, 5)]
    head = struct.pack("<2sHIH", b"II", 42, 8, len(entries)) + b"".join(struct.pack("<HHII", *e) for e in entries)
    body = head.ljust(200, b"\0") + struct.pack("<II", 216, 216 + 80) + struct.pack("<II", 80, 80) + b"".join(strips)
    (tmp_path / "i.tiff").write_bytes(body)
    got = {(r.r, r.c): (r.re, r.im) for r in binary.read_tiff(spark, str(tmp_path / "i.tiff")).collect()}
    assert len(got) == 32 and got[3, 7] == tuple(pairs[3, 7].tolist())


def test_orbit_files(spark, tmp_path):
    s = spark.createDataFrame([("s1", k, 2020, 33, 100.5, 1.0 * k, 2.0, 3.0, 4.0, 5.0, 6.0) for k in range(3)], "scene string, k int, yr int, jd int, sec double, x double, y double, z double, vx double, vy double, vz double")
    binary.write_orbit(s, str(tmp_path / "o"), 10.0)
    got = binary.read_orbit(spark, str(tmp_path / "o" / "scene=s1")).orderBy("k").collect()
    assert [(r.k, r.yr, r.t, r.x, r.vz) for r in got] == [(k, 2020, 33 * 86400 + 100.5 + 10 * k, float(k), 6.0) for k in range(3)]


def test_tables_delays_and_points(spark, tmp_path):
    (tmp_path / "scene.tab").write_text("2015001 10\n2015013 22\n\n")
    assert [(r.id, r.day) for r in binary.read_table(spark, str(tmp_path / "scene.tab"), ["id", "day"], 2).collect()] == [("2015001", "10"), ("2015013", "22")]
    with pytest.raises(ValueError):
        binary.read_table(spark, str(tmp_path / "scene.tab"), ["id", "day"], 3)
    (tmp_path / "d.ztd").write_bytes(np.array([1, 0, 3, 4, 5, 6], "<f4").tobytes())
    (tmp_path / "d.ztd.rsc").write_text("WIDTH 3\nFILE_LENGTH 2\nX_FIRST 10.0\nY_FIRST 50.0\n")
    got = sorted((r.lat, r.lon, r.z) for r in binary.read_delay(spark, str(tmp_path / "d.ztd")).where("z is not null").collect())
    assert len(got) == 5 and got[-1] == (50.0, pytest.approx(10 + 2 / 1200), 3.0)
    cells = spark.createDataFrame([(1, 2, 3.5), (4, 5, None)], "r long, c long, z double")
    binary.write_points(cells, str(tmp_path / "xyz"))
    assert [tuple(r) for r in binary.read_points(spark, str(tmp_path / "xyz")).collect()] == [(1, 2, 3.5)]
    binary.write_grid(cells, str(tmp_path / "g"), "t", "r", "cmd")
    assert spark.read.parquet(str(tmp_path / "g")).schema["z"].metadata == {"title": "t", "remark": "r", "command": "cmd"}


def test_pairs_as_a_table_function(spark):
    spark.udtf.register("key_values", pairs_function())
    got = spark.sql("select t.* from values ('PRF = 1\n# PRF = 2\nodd\nname = x = y') as v(text), lateral key_values(text) t").collect()
    assert [tuple(r) for r in got] == [(0, "PRF", "1"), (3, "name", "x = y")]


def test_defaults_and_updates(spark):
    kv = spark.createDataFrame([("s", "a", "1"), ("t", "b", "2")], "scene string, key string, value string")
    assert {tuple(r) for r in params.with_defaults(kv, {"a": "0"}).collect()} == {("s", "a", "1"), ("t", "a", "0")}
    assert {tuple(r) for r in params.updated(kv, "a", "9").collect()} == {("s", "a", "9"), ("t", "a", "9"), ("t", "b", "2")}


def test_splines_and_hermite():
    x = np.linspace(0, 6, 30)
    at = np.linspace(0.1, 5.9, 77)
    assert np.abs(rows.spline(x, np.sin(x), at) - np.sin(at)).max() < 2e-3 and np.allclose(rows.spline(x, 2 * x + 1, at), 2 * at + 1)
    t = np.arange(0, 200, 10.0)
    got = rows.hermite(t, 7e6 * np.cos(t / 950), -7e6 / 950 * np.sin(t / 950), np.array([0.0, 3.3, 95.7, 190.0]))
    assert np.allclose(got, 7e6 * np.cos(np.array([0.0, 3.3, 95.7, 190.0]) / 950), atol=1e-5)
    with pytest.raises(ValueError):
        rows.hermite(t, t, t, np.array([191.0]))


def test_spectra():
    n = 64
    z = np.exp(2j * np.pi * 5 * np.arange(n) / n)
    assert np.allclose(rows.fft_interpolated(z, 4), np.exp(2j * np.pi * 5 * np.arange(4 * n) / (4 * n)))
    both = z + np.exp(-2j * np.pi * 20 * np.arange(n) / n)
    low, high = rows.band(both, -0.5, 0), rows.band(both, 0, 0.5)
    assert np.allclose(np.abs(low), 1) and np.allclose(np.abs(high), 1)


def test_kernels_by_row(spark):
    d = spark.createDataFrame([(r, c, float(r + c * c)) for r in range(3) for c in range(8)], "r long, c long, z double")
    got = rows.by_row(d, lambda c, z: {"at": [2.5], "z": rows.spline(c, z, np.array([2.5]))}, "r", "c", ["c", "z"], "r long, at double, z double").orderBy("r").collect()
    assert [r.z for r in got] == [pytest.approx(6.25 + r, abs=0.1) for r in range(3)]


def test_shift_and_short(spark):
    assert projections.split_shift(3.25) == (3, 0.25) and projections.split_shift(-3.25) == (-4, 0.75) and projections.split_shift(0.0) == (0, 0.0)
    assert [r[0] for r in spark.createDataFrame([(0.5,), (-0.5,), (9e9,), (-9e9,)], "x double").select(projections.short(F.col("x"))).collect()] == [1, 0, 32767, -32768]


def test_chains_skip_what_is_there(spark, tmp_path):
    calls = []

    def stage(name):
        def run(runner):
            calls.append(name)
            return runner.spark.range(3) if name == "a" else runner.table("a").selectExpr("id + 1 as id")

        return name, run

    r = stages.Runner(spark, str(tmp_path / "run"), stages.tier("fast"))
    assert r.run([stage("a"), stage("b")]) == [("a", "made"), ("b", "made")]
    again = stages.Runner(spark, str(tmp_path / "run"))
    again.clean("b")
    assert again.run([stage("a"), stage("b")]) == [("a", "there"), ("b", "made")] and calls == ["a", "b", "b"]
    assert stages.Runner(spark, str(tmp_path / "run")).run([stage("a"), stage("b")], first="b", leave_out=("b",)) == [("a", "left out"), ("b", "left out")]
    assert spark.read.json(str(tmp_path / "run/_lineage")).count() == 2 and again.table("b").count() == 3
    out = stages.Runner(spark, str(tmp_path / "many")).batch(spark.createDataFrame([("p1",), ("p2",)], "pair string"), lambda _: [stage("a")], "pair")
    assert out == {"p1": [("a", "made")], "p2": [("a", "made")]}
    assert stages.tier("quality", memory_gb=8)["decimation"] == 4 and stages.settings(["a = 1 # x", "# b = 2", "a = 3"]) == {"a": "3"}


def test_streams_of_sessions_repeats_and_the_latest_state(spark, tmp_path):
    from fringelake.streaming.events import latest_before, once, sessions

    e = spark.createDataFrame([(i, f"2024-01-01 00:{m:02d}:00", u) for i, (m, u) in enumerate([(0, 1), (5, 1), (5, 1), (40, 1), (2, 2)])] + [(1, "2024-01-01 00:05:00", 1)], "event_id long, ts string, user_id long").withColumn("ts", F.col("ts").cast("timestamp"))
    e.repartition(1).write.parquet(str(tmp_path / "e"))
    states = spark.createDataFrame([(1, "2024-01-01 00:01:00", 10.0), (1, "2024-01-01 00:30:00", 20.0)], "user_id long, at string, value double").withColumn("at", F.col("at").cast("timestamp"))
    for name, make in (("s", sessions), ("o", once), ("l", lambda x: latest_before(x, states))):
        mode = "complete" if name == "s" else "append"
        q = make(spark.readStream.schema(e.schema).parquet(str(tmp_path / "e"))).writeStream.outputMode(mode).format("memory").queryName(f"stream_{name}").start()
        q.processAllAvailable()
        q.stop()
    assert sorted((r.user_id, r.n) for r in spark.table("stream_s").collect()) == [(1, 1), (1, 4), (2, 1)]
    assert spark.table("stream_o").count() == 5
    assert {(r.event_id, r.value) for r in spark.table("stream_l").collect()} == {(0, None), (1, 10.0), (2, 10.0), (3, 20.0), (4, None)}
