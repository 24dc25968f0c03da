"""Extensions over an event stream: windowed means with late data, and repaired line counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_stack(events: DataFrame, late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Count and mean per type and window; the same plan serves batches and streams."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))  # watermarks need a zone
    return timed.withWatermark("ts", late).groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.avg("value").alias("mean")).select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n", "mean")


def repaired(lines: DataFrame, most: int = 900) -> DataFrame:
    """``lines (line, ord, counter)`` with gaps of up to ``most`` filled by rows of counter 0; counters that fall back are dropped."""
    w = Window.partitionBy("line").orderBy("ord")
    seen = F.max("counter").over(w.rowsBetween(Window.unboundedPreceding, -1))
    kept = lines.withColumn("seen", seen).where("seen is null or counter > seen")
    gap = F.coalesce(F.col("counter") - F.col("seen"), F.lit(1))
    return kept.select("line", "ord", "counter", F.explode(F.sequence(F.lit(1), F.when(gap <= most, gap).otherwise(1).cast("int"))).alias("k"), gap.alias("gap")).select("line", "ord", F.when((F.col("k") == F.col("gap")) | (F.col("gap") > most), F.col("counter")).otherwise(0).alias("counter"), "k")


def sessions(events: DataFrame, gap: str = "20 minutes", late: str = "1 hour") -> DataFrame:
    """Events per user and session; a session ends after a gap without events."""
    return events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), "n")


def once(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Each event once, although it may be sent again within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def latest_before(events: DataFrame, states: DataFrame) -> DataFrame:
    """Each event of a stream with the latest of its user's ``states (user_id, at, value)`` at or before it.

    The states are a table: one sorted array a user, joined to the stream without any state of its own.
    """
    s = states.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("s"))
    last = F.element_at(F.filter("s", lambda x: x["at"] <= F.col("ts")), -1)
    return events.join(s, "user_id", "left").select("event_id", "ts", "user_id", F.when(F.size(F.filter("s", lambda x: x["at"] <= F.col("ts"))) > 0, last["value"]).alias("value"))
