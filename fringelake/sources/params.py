"""Key-value parameter files: ``key = value`` lines, ``#`` lines skipped, the last value of a key wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def last_wins(kv: DataFrame, by: str = "scene") -> DataFrame:
    """``kv (scene, ord, key, value)`` with one row per key: the value of the greatest ord."""
    return kv.groupBy(by, "key").agg(F.max_by("value", "ord").alias("value"))


def read_params(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    lines = spark.read.text(paths, wholetext=True).select(F.input_file_name().alias("scene"), F.posexplode(F.split("value", r"\r?\n")).alias("ord", "line"))
    lines = lines.where(~F.contains("line", F.lit("#")) & F.contains("line", F.lit("=")))
    kv = lines.select("scene", "ord", F.trim(F.split_part("line", F.lit("="), F.lit(1))).alias("key"), F.trim(F.regexp_replace("line", r"^[^=]*=", "")).alias("value"))
    return last_wins(kv)


def typed(kv: DataFrame, kinds: dict[str, str], by: str = "scene") -> DataFrame:
    """One row per scene with the named keys as columns; what is absent or malformed is NULL."""
    wide = kv.groupBy(by).pivot("key", list(kinds)).agg(F.first("value"))
    return wide.select(by, *[F.expr(f"try_cast(`{k}` as {t})").alias(k) for k, t in kinds.items()])


def write_params(kv: DataFrame, path: str, by: str = "scene") -> None:
    """Set keys only, one folder per scene."""
    kv.where("value is not null").select(by, F.concat_ws(" = ", "key", "value").alias("line")).write.partitionBy(by).text(path)


def with_defaults(kv: DataFrame, defaults: dict[str, str], by: str = "scene") -> DataFrame:
    """The keys of ``defaults`` for every scene: its own value, else the default."""
    every = kv.select(by).distinct().select(by, F.explode(F.create_map(*[F.lit(x) for kv_ in defaults.items() for x in kv_])).alias("key", "unset"))
    return every.join(kv, [by, "key"], "left").select(by, "key", F.coalesce("value", "unset").alias("value"))


def updated(kv: DataFrame, key: str, value: str, by: str = "scene") -> DataFrame:
    """``kv`` with one key set in every scene."""
    return kv.where(F.col("key") != key).select(by, "key", "value").unionByName(kv.select(by).distinct().select(by, F.lit(key).alias("key"), F.lit(value).alias("value")))
