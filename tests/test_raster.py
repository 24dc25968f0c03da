"""Every query of the raster engine against its SQL, on the smallest tables, and closed-form fixtures."""

import glob
import math
import os

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fringelake.functions import algebra as A
from fringelake.functions.bitmask import compile_flags, tokens
from fringelake.operators import joins, stats, tiles
from fringelake.plans import queries as Q
from fringelake.sources.params import read_params, typed, write_params
from fringelake.streaming.events import repaired, running_stack

SF = "/root/testdata/sf0.001"


def rows(df):
    cols = sorted(df.columns)
    return sorted(tuple("None" if pd.isna(x) else repr(round(float(x), 6) + 0.0) if isinstance(x, (float, int)) and not isinstance(x, bool) else str(x) for x in r) for r in df[cols].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_query(spark, name):
    got = Q.queries()[name](spark, SF)
    if name not in Q.oracle_sql():
        assert got.count() > 0
        return
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    want = con.execute(Q.oracle_sql()[name]).df()
    got = got.toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_pairs_at_exact_bounds(spark):
    s = spark.createDataFrame([(1, 0, 0.0), (2, 50, 39.99), (3, 100, 40.0), (4, 100, 40.99)], "id long, day int, bperp double")
    assert {(r.ref, r.rep) for r in joins.select_pairs(s, 100, 40).collect()} == {(1, 2), (2, 3), (2, 4)}
    assert {(r.ref, r.rep) for r in joins.select_pairs(s, 101, 41).collect()} == {(1, 2), (1, 3), (1, 4), (2, 3), (2, 4)}


def test_wrap_and_masks(spark):
    r = spark.range(1).select(A.wrap(F.lit(3 * math.pi + 0.1)).alias("w"), A.clip_high(F.lit(None).cast("double"), 1.0).alias("c"), A.sigma(F.lit(0.005)).alias("s"), A.missing(F.lit(float("nan"))).alias("m")).first()
    assert r.w == pytest.approx(-math.pi + 0.1) and r.c is None and r.s == 99.99 and r.m is None


def test_flags(spark):
    d = spark.createDataFrame([(i,) for i in range(8)], "flags int")
    got = [r.flags for r in d.where(compile_flags("A or B and !C", {"A": 1, "B": 2, "C": 4})).collect()]
    assert got == [i for i in range(8) if i & 1 or (i & 2 and not i & 4)]
    assert tokens("flags.A AND(b)") == ["flags.A", "&", "(", "b", ")"]
    for bad in ("A and", "(A", "A B", "A $ B"):
        with pytest.raises((ValueError, KeyError)):
            compile_flags(bad, {"A": 1, "B": 2})


def test_params(spark, tmp_path):
    (tmp_path / "a.PRM").write_text("PRF = 1000\n# PRF = 7\nPRF = 1500.5\nname = x y\nodd line\nbins = many\n")
    kv = read_params(spark, str(tmp_path / "a.PRM"))
    r = typed(kv, {"PRF": "double", "name": "string", "bins": "int", "none": "int"}).first()
    assert (r.PRF, r.name, r.bins, r.none) == (1500.5, "x y", None, None)
    write_params(kv.withColumn("scene", F.lit("s1")), str(tmp_path / "out"))
    assert "PRF = 1500.5" in {r.value for r in spark.read.text(str(tmp_path / "out/scene=s1")).collect()}


def test_convolution_keeps_a_constant_at_edges(spark):
    g = spark.range(20).select((F.col("id") % 4).alias("r"), F.floor(F.col("id") / 4).alias("c"), F.lit(7.0).alias("z"))
    got = stats.convolve(g, [(i, j, 1.0 + i * i) for i in (-1, 0, 1) for j in (-2, -1, 0, 1, 2)]).collect()
    assert len(got) == 20 and all(r.z == pytest.approx(7) for r in got)


def test_goldstein_keeps_a_constant_phase(spark):
    g = spark.range(64 * 64).select(F.floor(F.col("id") / 64).alias("r"), (F.col("id") % 64).alias("c"), F.lit(0.6).alias("re"), F.lit(0.8).alias("im"))
    mid = tiles.goldstein(g).where("r between 20 and 40 and c between 20 and 40").select(F.atan2("im", "re").alias("p")).toPandas()
    assert (mid.p - math.atan2(0.8, 0.6)).abs().max() < 1e-6


def test_sbas_recovers_a_ramp(spark):
    pairs = [(0, 1, 0.0), (1, 2, 0.0), (0, 2, 0.0)]
    s = spark.createDataFrame([(p, k, (b - a) * float(p), 1.0) for p in (1, 2) for k, (a, b, _) in enumerate(pairs)] + [(3, k, None, 1.0) for k in range(3)], "pixel long, intf int, phase double, sigma double")
    got = {(r.pixel, r.scene): r.disp for r in tiles.sbas(s, pairs, [0, 12, 24]).collect()}
    assert got[2, 2] == pytest.approx(4) and got[1, 1] == pytest.approx(1) and got[3, 2] is None


def test_line_repair(spark):
    d = spark.createDataFrame([("a", i, c) for i, c in enumerate([5, 6, 9, 8, 10, 2000])], "line string, ord int, counter long")
    assert [r.counter for r in repaired(d).orderBy("ord", "k").collect()] == [5, 6, 0, 0, 9, 10, 2000]


def test_stream_equals_batch(spark, tmp_path):
    e = spark.read.parquet(f"{SF}/events.parquet")
    e.orderBy("ts").repartition(1).write.parquet(str(tmp_path / "in"))
    stream = running_stack(spark.readStream.schema(e.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("running").start()
    q.processAllAvailable()
    q.stop()
    assert rows(spark.table("running").toPandas()) == rows(running_stack(e).toPandas())
