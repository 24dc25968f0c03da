"""Benchmark decontamination by winnowing [native].

Words are hashed in runs of ``RUN``; of each window of ``WINDOW`` words (``SPAN`` runs) the least hash is kept, the first
of equal ones. Neighbouring windows mostly keep the same run, so the places kept are few: the fingerprints. As the choice
depends on a window's words alone, every shared window leaves a common fingerprint on both sides. Fingerprints are joined
by hash, and each hit is extended word by word to either side as far as the windows that keep it can reach; extents of
``WINDOW`` words or more are hits, so text decides, not the hash.

Documents are read once. In that scan a fixed bitmap of the benchmark's hashes (``BITS`` bits, a constant size) leaves
documents without any such run with their word count alone; the others are winnowed, and each fingerprint that the bitmap
lets through goes on with the few words around it. So no word arrays are shuffled, and a benchmark of any size only
makes the bitmap let more through. The benchmark's fingerprints are broadcast within counted bounds, and shuffled beyond.

Items shorter than a window have one fingerprint, the hash of all their words, and are found at every place that has it.

Defined cases: null, empty and wordless texts have no words, are never contaminated and give no windows; repeated rows
get the same result each; an empty benchmark or corpus is fine; null item ids are left out of the lists; very long texts
are one row like others; other columns of the inputs are not read, whatever their names.
"""

from __future__ import annotations

import string

import numpy as np

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, small_side, stored

WINDOW, RUN = 13, 8
SPAN = WINDOW - RUN + 1
SIDE = WINDOW - RUN  # words on either side of a run that its windows reach
BITS = 1 << 21


def words(text: Column) -> Column:
    """Maximal runs of 0-9, a-z and anything beyond ASCII, after lower-casing A-Z alone."""
    text = F.coalesce(text, F.lit(""))
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def run_hashes(df: DataFrame, length: int, name: str) -> DataFrame:
    """Adds ``name``: of the word hashes ``h``, a hash of each ``length`` neighbours, by doubling; the last ``length - 1`` have no meaning."""
    def joined(a: Column, by: int):
        return lambda x, i: F.xxhash64(x, F.get(a, i + by))

    made, last, have = [], "h", 1
    while have < length:
        by = min(have, length - have)
        have += by
        new = name if have == length else f"{name}_{have}"
        df = df.withColumn(new, F.transform(last, joined(F.col(last), by)))
        made.append(last)
        last = new
    df = df.drop(*made[1:])
    return df.withColumn(name, F.transform("h", lambda x: F.xxhash64(x))) if length == 1 else df


def winnowed(g: Column, n: Column) -> Column:
    """Places of the runs that some window of ``n`` words keeps."""

    def kept(s: Column) -> Column:
        return F.array_min(F.array(*[F.struct(F.get(g, s + i).alias("g"), (s + i).alias("at")) for i in range(SPAN)]))["at"]

    return F.array_distinct(F.transform(F.sequence(F.lit(0), n - WINDOW), kept))


def around(w: Column, at: Column, length: int, side: int) -> Column:
    """The words from ``side`` before a run to ``side`` behind it; null beyond the text."""
    return F.array(*[F.when(at + i >= 0, F.get(w, at + i)) for i in range(-side, length + side)])


PRINT = "array<struct<length:int,print:bigint,at:int,near:array<string>>>"


def prints(df: DataFrame, short: list[int], passes, whole: bool) -> DataFrame:
    """Turns ``words`` of ``df`` into n and ``prints`` (length, print, at, near): winnowed runs, and runs of the short lengths.

    ``passes(hash)`` says which to keep; ``whole``: a short run has to be the whole text, else it may be anywhere.
    """
    others = df.drop("words").columns
    n, w = F.col("n"), F.col("words")
    df = df.select("*", F.size("words").alias("n"), F.transform("words", lambda x: F.xxhash64(x)).alias("h"))
    df = run_hashes(df, RUN, "g")

    def one(g: Column, label: int, size: int, side: int):
        return lambda at: F.struct(F.lit(label).alias("length"), F.get(g, at).alias("print"), at.cast("int").alias("at"), around(w, at, size, side).alias("near"))

    def kept(g: Column):
        return lambda at: passes(F.get(g, at))

    g = F.col("g")
    found = [F.when((n >= WINDOW) & F.exists("g", passes), F.transform(F.filter(winnowed(g, n), kept(g)), one(g, RUN, RUN, SIDE)))]
    for m in short:  # labelled by their length below zero
        df = run_hashes(df, m, f"s{m}")
        g = F.col(f"s{m}")
        found.append(F.when((n == m) if whole else (n >= m), F.transform(F.filter(F.sequence(F.lit(0), n - m), kept(g)), one(g, -m, m, 0))))
    none = F.array().cast(PRINT)
    return df.select(*others, "n", F.concat(*[F.coalesce(x, none) for x in found]).alias("prints"))


def probes(h: Column) -> list[Column]:
    """The bits that stand for a hash."""
    return [F.pmod(h, F.lit(BITS)), F.pmod(F.shiftright(h, 24), F.lit(BITS))]


def bitmap(hashes: DataFrame) -> DataFrame:
    """One row: an array of ``BITS`` bits in longs, with those of all ``print`` set."""
    at = hashes.select(F.explode(F.array(*probes(F.col("print")))).alias("at"))
    set_ = at.groupBy(F.shiftright("at", 6).alias("id")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("at", F.lit(64)).cast("int"))).alias("bits"))
    every = hashes.sparkSession.range(BITS // 64).join(F.broadcast(set_), "id", "left")  # at most BITS / 64 rows
    return every.agg(F.sort_array(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))).alias("b")).select("b.bits")


def extended(near: Column, other: Column) -> tuple[Column, Column]:
    """Equal words to the left of an equal run, and to its right; both -1 if the run differs."""

    def same(i: int) -> Column:
        return F.coalesce(F.get(near, F.lit(i)) == F.get(other, F.lit(i)), F.lit(False))

    def reach(places: list[int]) -> Column:
        out = F.lit(len(places))
        for k in range(len(places) - 1, -1, -1):
            out = F.when(~same(places[k]), k).otherwise(out)
        return out

    run = same(SIDE)
    for i in range(SIDE + 1, SIDE + RUN):
        run = run & same(i)
    return F.when(run, reach(list(range(SIDE - 1, -1, -1)))).otherwise(-1), F.when(run, reach(list(range(SIDE + RUN, 2 * SIDE + RUN)))).otherwise(-1)


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id", bench_text: str = "text", least_share: int = 20, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per document: its id, n_words, n_hit, n_items, items_sha256, contaminated (20 * n_hit >= n_words > 0)."""
    tests = benchmark.select(F.col(item).alias("item"), words(F.col(bench_text)).alias("words"))
    short = sorted(r[0] for r in tests.select(F.size("words").alias("n")).where(f"n > 0 and n < {WINDOW}").distinct().collect())  # at most WINDOW - 1 lengths
    tests = prints(tests, short, lambda h: h.isNotNull(), True).select("item", F.explode_outer("prints").alias("p")).where("p is not null").select("item", "p.length", "p.print", "p.near")  # outer: the filter of an inner one would repeat the expressions below
    tests = stored(tests.distinct(), "tests")
    # a constant in the plan: as a column it would be copied with each row
    bits = F.lit(np.array(bitmap(tests).first().bits, np.int64))

    def passes(h: Column) -> Column:
        first, second = (F.getbit(F.get(bits, F.shiftright(at, 6).cast("int")), F.pmod(at, F.lit(64)).cast("int")) == 1 for at in probes(h))
        return first & second

    scan = docs.select(F.col(doc).alias("doc_id"), F.coalesce(F.col(doc).cast("string"), F.lit("")).alias("k1"), F.xxhash64(F.col(text)).alias("k2"), words(F.col(text)).alias("words"))
    scan = stored(prints(scan, short, passes, False), "scan")
    own = scan.where(F.size("prints") > 0).groupBy("k1", "k2").agg(F.first("prints").alias("prints"))  # equal rows once
    own = own.select("k1", "k2", F.explode("prints").alias("p")).select("k1", "k2", "p.*")
    # texts around equal fingerprints once, whatever the number of items that have them
    contexts = small_side(tests.select("length", "print", F.col("near").alias("other")).distinct(), broadcast_rows)
    left, right = extended(F.col("near"), F.col("other"))
    hits = own.join(contexts, ["length", "print"]).select("k1", "k2", "length", "print", "other", "at", (F.col("near") == F.col("other")).alias("same"), left.alias("l"), right.alias("r"))
    is_short = F.col("length") < 0
    hits = hits.where(F.when(is_short, F.col("same")).otherwise(F.col("l") + F.col("r") + RUN >= WINDOW))
    hits = hits.select("k1", "k2", "length", "print", "other", F.when(is_short, F.col("at")).otherwise(F.col("at") - F.col("l")).cast("long").alias("s"), F.when(is_short, -F.col("length")).otherwise(F.col("l") + F.col("r") + RUN).cast("long").alias("n"))
    hits = stored(hits, "hits")
    start = F.struct(F.lit(0).cast("long").alias("to"), F.lit(0).cast("long").alias("hit"))

    def cover(acc: Column, x: Column) -> Column:
        end = x["s"] + x["n"]
        return F.struct(F.greatest(acc["to"], end).alias("to"), (acc["hit"] + F.greatest(F.lit(0).cast("long"), end - F.greatest(acc["to"], x["s"]))).alias("hit"))

    covered = hits.groupBy("k1", "k2").agg(F.array_sort(F.collect_set(F.struct("s", "n"))).alias("spans")).select("k1", "k2", F.aggregate("spans", start, cover, lambda a: a["hit"]).alias("n_hit"))
    owners = small_side(tests.where("item is not null").select("item", "length", "print", F.col("near").alias("other")), broadcast_rows)
    items = hits.select("k1", "k2", "length", "print", "other").distinct().join(owners, ["length", "print", "other"]).select("k1", "k2", F.col("item").cast("string").alias("item")).distinct()
    items = items.groupBy("k1", "k2").agg(F.count("*").alias("n_items"), F.array_join(F.array_sort(F.collect_list("item")), ",").alias("listed"))  # the list is the result
    found = small_side(stored(covered.join(items, ["k1", "k2"], "left"), "found"), broadcast_rows)
    out = scan.select("doc_id", "k1", "k2", F.col("n").cast("long").alias("n_words")).join(found, ["k1", "k2"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"), F.sha2(F.coalesce("listed", F.lit("")).cast("binary"), 256).alias("items_sha256"), ((n_hit > 0) & (n_hit * least_share >= F.col("n_words"))).alias("contaminated"))
