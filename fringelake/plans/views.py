"""The engine's inputs as views of the driver's tables, and the same views as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import stats


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def scenes(self) -> DataFrame:
        return self.table("supplier").select(F.col("s_suppkey").alias("id"), (F.col("s_suppkey") * 12).alias("day"), (F.col("s_acctbal") / 50).alias("bperp"))

    def stack(self) -> DataFrame:
        return self.table("lineitem").groupBy(F.col("l_partkey").alias("pixel"), F.col("l_linenumber").alias("scene")).agg((F.avg("l_extendedprice") / 9973.0).alias("z"), F.avg(F.col("l_discount") * 9 + 0.05).alias("c"))

    def ordered_stack(self) -> DataFrame:
        """The stack by sums in the order of the table's rows, as one thread sums in SQL; for thresholds and ranks."""
        rows = self.table("lineitem").select("*", F.col("l_partkey").alias("pixel"), F.col("l_linenumber").alias("scene"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
        return stats.ordered_means(rows, ["pixel", "scene"], ["file", "row"], {"z": F.col("l_extendedprice"), "c": F.col("l_discount") * 9 + 0.05}).withColumn("z", F.col("z") / 9973.0)

    def cells(self) -> DataFrame:
        return self.table("lineitem").groupBy((F.col("l_orderkey") % 64).alias("r"), (F.col("l_partkey") % 64).alias("c")).agg((F.avg("l_extendedprice") / 9973.0).alias("z"), F.avg(F.col("l_tax") * 9.973 - 0.4).alias("im"))

    def offsets(self) -> DataFrame:
        return self.table("lineitem").select(F.col("l_partkey").alias("x"), F.col("l_tax").alias("dx"), F.col("l_orderkey").alias("y"), F.col("l_discount").alias("dy"), F.col("l_quantity").alias("snr"))


SCENES = "scenes as (select s_suppkey as id, s_suppkey * 12 as day, s_acctbal / 50 as bperp from supplier)"
STACK = "stack as (select l_partkey as pixel, l_linenumber as scene, avg(l_extendedprice) / 9973.0 as z, avg(l_discount * 9 + 0.05) as c from lineitem group by 1, 2)"
CELLS = "cells as (select l_orderkey % 64 as r, l_partkey % 64 as c, avg(l_extendedprice) / 9973.0 as z, avg(l_tax * 9.973 - 0.4) as im from lineitem group by 1, 2)"
OFFSETS = "offsets as (select l_partkey as x, l_tax as dx, l_orderkey as y, l_discount as dy, l_quantity as snr from lineitem)"
PAIRS = f"{SCENES}, pairs as (select a.id as ref, b.id as rep, a.day as d1, b.day as d2, a.bperp as b1, b.bperp as b2 from scenes a join scenes b on b.day > a.day and b.day - a.day < 100 and trunc(abs(a.bperp - b.bperp)) < 40)"
