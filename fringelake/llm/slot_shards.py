"""Sharding by fixed virtual slots [native].

Each record hashes by its key into one of ``n_slots`` virtual slots; rows and bytes are aggregated per slot; a
versioned table maps slots to shards. A slot map has ``n_slots`` rows whatever the data, so it may be broadcast or
collected. Growing or rebalancing edits the map: only the records of moved slots change their shard.

Defined cases: a null key hashes as the empty string; a null text has no bytes; repeated rows get places of their
own, one after another; rows of one key, or of none, share a slot but are ranked in ``PARTS`` parts by their texts; an
empty table gives no rows; other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

N_SLOTS = 4096
PARTS = 16  # of a slot, ranked apart: a slot with a hot key is no single task


def slot_of(key: Column, n_slots: int = N_SLOTS) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(n_slots)).cast("int")


def first_map(spark: SparkSession, n_shards: int, n_slots: int = N_SLOTS) -> DataFrame:
    """Version 1: slots dealt round. Columns: version, slot, shard."""
    return spark.range(n_slots).select(F.lit(1).alias("version"), F.col("id").cast("int").alias("slot"), F.pmod("id", F.lit(n_shards)).cast("int").alias("shard"))


def grown_map(slots: DataFrame, n_shards: int) -> DataFrame:
    """The next version with shard ``n_shards`` added: it takes every old shard's slots beyond an even share, highest first."""
    rank = F.row_number().over(Window.partitionBy("shard").orderBy("slot"))
    all_slots = F.count("*").over(Window.partitionBy("version"))
    keep = F.ceil(all_slots / F.lit(n_shards + 1))
    return slots.withColumn("n", rank).withColumn("keep", keep).select(
        (F.col("version") + 1).alias("version"), "slot", F.when(F.col("n") > F.col("keep"), F.lit(n_shards)).otherwise(F.col("shard")).cast("int").alias("shard")
    )


def rebalanced_map(slots: DataFrame, loads: DataFrame, tolerance: float = 0.02, max_moves: int | None = None) -> DataFrame:
    """The next version, edited by the slots' bytes (``loads``: slot, bytes): slots go from the fullest shard to the
    emptiest while that narrows the gap and the fullest exceeds the mean by more than ``tolerance``.

    Works on the map's ``n_slots`` rows, a bound that does not grow with the data.
    """
    spark = slots.sparkSession
    rows = slots.join(loads.select("slot", "bytes"), "slot", "left").select("version", "slot", "shard", F.coalesce("bytes", F.lit(0)).alias("bytes")).orderBy("slot").collect()
    held: dict[int, dict[int, int]] = {}
    for r in rows:
        held.setdefault(r.shard, {})[r.slot] = r.bytes
    total = {k: sum(v.values()) for k, v in held.items()}
    mean = sum(total.values()) / max(1, len(total))
    for _ in range(max_moves if max_moves is not None else len(rows)):
        full, free = max(total, key=lambda k: (total[k], k), default=None), min(total, key=lambda k: (total[k], -k), default=None)
        if full is None or total[full] <= mean * (1 + tolerance):
            break
        gap = total[full] - total[free]
        fits = [(b, -s) for s, b in held[full].items() if 0 < b < gap]
        if not fits:
            break
        b, s = min(fits, key=lambda x: (abs(2 * x[0] - gap), -x[1]))
        del held[full][-s]
        held[free][-s] = b
        total[full] -= b
        total[free] += b
    version = rows[0].version + 1 if rows else 1
    return spark.createDataFrame([(version, s, k) for k, v in held.items() for s in v], "version int, slot int, shard int")


def save_map(slots: DataFrame, path: str) -> None:
    """Append a version to the stored table of maps; earlier versions stay readable."""
    slots.coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    table = spark.read.schema("slot int, shard int, version int").parquet(path)
    if version is None:
        version = table.agg(F.max("version")).first()[0]
    return table.where(F.col("version") == version).select("version", "slot", "shard")


def slot_loads(records: DataFrame, by: tuple[str, ...] = ("virtual_slot",)) -> DataFrame:
    """Rows and bytes per slot of ``records (virtual_slot, size, n)``, combined before the shuffle."""
    return records.groupBy(*by).agg(F.sum("n").alias("rows"), F.sum(F.col("n") * F.col("size")).alias("bytes"))


def place(docs: DataFrame, slots: DataFrame, grown: DataFrame | None = None, key: str = "doc_id", text: str = "text", n_slots: int = N_SLOTS) -> DataFrame:
    """Each document's shard under ``slots``, its place there (gapless from 0), and its shard under ``grown``.

    Places: slots of a shard follow one another, and the parts of a slot, so a place is its part's base plus a rank within
    the part. Identical rows are counted before they are ranked, so a repeated row is no hot group.
    """
    data = F.coalesce(F.col(text), F.lit(""))
    records = docs.select(F.col(key).alias("doc_id"), (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data.cast("binary")).alias("text_crc32"), slot_of(F.col(key), n_slots).alias("virtual_slot"))
    records = records.groupBy("doc_id", "size", "text_crc32", "virtual_slot").agg(F.count("*").alias("n"))
    records = records.withColumn("part", F.pmod("text_crc32", F.lit(PARTS)).cast("int"))
    maps = slots.select(F.col("slot").alias("virtual_slot"), "shard", F.col("version").alias("map_version"))
    if grown is not None:
        maps = maps.join(grown.select(F.col("slot").alias("virtual_slot"), F.col("shard").alias("grown_shard")), "virtual_slot")
    else:
        maps = maps.withColumn("grown_shard", F.lit(None).cast("int"))
    loads = slot_loads(records, ("virtual_slot", "part"))  # at most n_slots * PARTS rows
    whole = Window.partitionBy("virtual_slot")
    before = Window.partitionBy("shard").orderBy("virtual_slot", "part").rowsBetween(Window.unboundedPreceding, -1)
    maps = maps.join(loads, "virtual_slot").select("*", F.sum("bytes").over(whole).alias("slot_bytes"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("virtual_slot", "part").orderBy("doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    ranked = records.withColumn("ahead", F.coalesce(F.sum("n").over(within), F.lit(0)))
    placed = ranked.join(F.broadcast(maps), ["virtual_slot", "part"])  # at most n_slots * PARTS rows
    return placed.select(
        "doc_id", "size", "text_crc32", "shard", "grown_shard", "virtual_slot", "slot_bytes", "map_version",
        F.explode(F.sequence(F.col("base") + F.col("ahead"), F.col("base") + F.col("ahead") + F.col("n") - 1)).alias("slot"),
    )
