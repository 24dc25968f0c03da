"""Joins on bands, ranges and times, planned as equi-joins on derived buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def select_pairs(scenes: DataFrame, days: int, metres: float) -> DataFrame:
    """(ref, rep) with 0 < day gap < days and the truncated baseline gap < metres. A bucket is ``days`` long."""
    a = scenes.select(F.col("id").alias("ref"), F.col("day").alias("d1"), F.col("bperp").alias("b1"), F.explode(F.array(F.floor(F.col("day") / days), F.floor(F.col("day") / days) + 1)).alias("bucket"))
    b = scenes.select(F.col("id").alias("rep"), F.col("day").alias("d2"), F.col("bperp").alias("b2"), F.floor(F.col("day") / days).alias("bucket"))
    gap = F.col("d2") - F.col("d1")
    return a.join(b, "bucket").where((gap > 0) & (gap < days) & (F.abs(F.col("b1") - F.col("b2")).cast("long") < metres)).select("ref", "rep", "d1", "d2", "b1", "b2")


def covered(pairs: DataFrame, scenes: DataFrame, width: int) -> DataFrame:
    """(ref, rep, scene) for ref <= scene < rep; spans are spread over buckets of ``width`` ids."""
    p = pairs.select("ref", "rep", F.explode(F.sequence(F.floor(F.col("ref") / width), F.floor((F.col("rep") - 1) / width))).alias("bucket"))
    s = scenes.select(F.col("id").alias("scene"), F.floor(F.col("id") / width).alias("bucket"))
    return p.join(s, "bucket").where("scene >= ref and scene < rep").select("ref", "rep", "scene")


def symmetric(pairs: DataFrame, days: int = 5) -> DataFrame:
    """Edges i -> n that some n -> j continues with a gap that differs by less than ``days``."""
    e = pairs.select("ref", "rep", (F.col("d2") - F.col("d1")).alias("gap"))
    on = e.select(F.col("ref").alias("mid"), F.col("gap").alias("next"), F.floor(F.col("gap") / days).alias("bucket"))
    near = e.withColumn("bucket", F.explode(F.array(*[F.floor(F.col("gap") / days) + i for i in (-1, 0, 1)])))
    return near.join(on, (near.rep == on.mid) & (near.bucket == on.bucket) & (F.abs(F.col("gap") - F.col("next")) < days), "left_semi").select("ref", "rep").distinct()


def as_of(left: DataFrame, right: DataFrame, key: str, time: str, value: str) -> DataFrame:
    """Each left row with the latest ``value`` of its key at or before its time: one shuffle of the union, no range join."""
    both = left.withColumns({"_v": F.lit(None).cast(right.schema[value].dataType), "_o": F.lit(1)}).unionByName(right.select(key, time, F.col(value).alias("_v"), F.lit(0).alias("_o")), allowMissingColumns=True)
    w = Window.partitionBy(key).orderBy(time, "_o").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(value, F.last("_v", ignorenulls=True).over(w)).where("_o = 1").drop("_v", "_o")


def bilinear(points: DataFrame, grid: DataFrame) -> DataFrame:
    """Samples ``grid (r, c, z)`` at ``points (pid, y, x)``: the four neighbours are equi-joined and weighted; any missing makes it missing."""
    corner = F.explode(F.array(*[F.struct((F.floor("y") + i).alias("r"), (F.floor("x") + j).alias("c"), ((F.col("y") - F.floor("y") if i else 1 - F.col("y") + F.floor("y")) * (F.col("x") - F.floor("x") if j else 1 - F.col("x") + F.floor("x"))).alias("w")) for i in (0, 1) for j in (0, 1)]))
    near = points.select("pid", corner.alias("k")).select("pid", "k.r", "k.c", "k.w").where("w > 0")
    found = near.join(grid, ["r", "c"], "left").groupBy("pid").agg(F.sum(F.col("w") * F.col("z")).alias("z"), F.count_if(F.col("z").isNull()).alias("gaps"))
    return found.select("pid", F.when(F.col("gaps") == 0, F.col("z")).alias("z"))


def symmetric_both(pairs: DataFrame, days: int = 5) -> DataFrame:
    """Edges of ``symmetric`` and those that continue them: both halves of a time-symmetric couple."""
    turned = pairs.select((-F.col("rep")).alias("ref"), (-F.col("ref")).alias("rep"), "d1", "d2")
    return symmetric(pairs, days).union(symmetric(turned, days).select(-F.col("rep"), -F.col("ref"))).distinct()


def orphans(left: DataFrame, right: DataFrame, key: str, lacks_right: str, lacks_left: str, least: int) -> DataFrame:
    """(key, what) of the rows without a partner; nothing at all if fewer than ``least`` have one."""
    out = left.join(right, key, "left_anti").select(key, F.lit(lacks_right).alias("what")).union(right.join(left, key, "left_anti").select(key, F.lit(lacks_left)))
    return out.where(left.join(right, key, "left_semi").limit(least).agg(F.count("*")).scalar() >= least)
