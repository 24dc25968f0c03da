"""Helpers shared by the corpus operators: intermediate tables, bounded broadcasts, vectorised words."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and bytes of a side that may be broadcast after both have been counted.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 64 << 20
#: Bytes of text that one vectorised step handles; a longer text makes a step of its own.
STEP_BYTES = 2 << 20
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_local: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; where that is unset, in local mode, a new one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="fringelake-"))
        path = _local[0]
    return path.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it: lineage ends there, and lost executors cost nothing.

    The shuffle files of the write go when it is done, as nothing reads them any more.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete tables made by ``stored`` that no later plan reads."""
    for t in tables:
        at = t.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(t.stored_path)
        at.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _width(name: str, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(name), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.StringType):
            return F.coalesce(F.aggregate(name, F.lit(16), lambda n, x: n + F.coalesce(F.octet_length(x), F.lit(0)) + 16), F.lit(16))
        return 16 + 32 * F.greatest(F.size(name), F.lit(0))
    if isinstance(kind, T.MapType):
        return 16 + 32 * F.greatest(F.size(name), F.lit(0))
    return F.lit(64 if isinstance(kind, T.StructType) else 8)


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows and bytes are within the bounds; else unchanged, for a shuffled join."""
    width = F.lit(0).cast("long")
    for f in df.schema.fields:
        width = width + _width(f.name, f.dataType)
    n, total = df.limit(rows + 1).agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(df) if n <= rows and total <= size else df


def text_batches(spark: SparkSession) -> None:
    """Arrow batches hold few rows, as one text may have megabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores until ``docs`` has no such column."""
    have = {c.lower() for c in docs.columns}
    while name in have:
        name += "_"
    return name


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# --- vectorised words -------------------------------------------------------------------------------------------


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and each row's bounds in them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, ends, data = column.buffers()
    bounds = np.frombuffer(ends, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8, int(bounds[-1] - bounds[0]), int(bounds[0])), bounds - bounds[0]


def steps(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches of about ``size`` bytes of text each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        bounds = utf8(batch.column(batch.schema.get_field_index(text)))[1]
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_MARK = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_SLICE = 1 << 17  # bytes of words that are hashed at a time
_PLACES = 64  # places in a word that have values of their own for each byte; later places mix them with their block's number
#: 1 for a-z; 2 for digits and ASCII marks without the apostrophe, which parts words in ways of its own.
_KIND = np.array([1 if 97 <= i <= 122 else 2 if 0x21 <= i <= 0x7E and i != 0x27 and not chr(i).isalpha() else 0 for i in range(256)], np.uint8)
_BYTE = np.random.default_rng(7).integers(0, 2**63, _PLACES * 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD, _Q = np.uint64(0x9E3779B97F4A7C15), 0xD6E8FEB86659FD93
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        with np.errstate(over="ignore"):
            have = tuple(np.cumprod(np.r_[np.uint64(1), np.full(size - 1, np.uint64(b))], dtype=np.uint64) for b in (base, pow(base, -1, 1 << 64)))
        _powers[base] = have
    return have


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


class Words:
    """The words of many texts: bounds in the bytes, 64-bit hashes, and each text's share.

    Words are ``[^\\x20\\x09-\\x0D]+``, or with ``plain`` runs of ASCII letters, digits and bytes beyond ASCII. With
    ``fine`` they also end between a-z and an ASCII mark or digit.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray, lower: bool = False, hashes: bool = True, plain: bool = False, fine: bool = False) -> None:
        self.data = data = _LOWER[data] if lower else data
        n = len(data)
        self.white = white = (_MARK if plain else _WHITE)[data]
        before = np.empty(n + 1, bool)
        before[0] = True
        before[1:] = white
        after = before[1:].copy()
        after[: n - 1] = white[1:]
        if n:
            after[n - 1] = True
        before = before[:n]
        inner = bounds[(bounds > 0) & (bounds < n)]
        before[inner] = True
        after[inner - 1] = True
        if fine and n > 1:
            kind = _KIND[data]
            parted = kind[:-1] + kind[1:] == 3
            before[1:] |= parted
            after[:-1] |= parted
        self.starts = np.flatnonzero(~white & before)
        self.ends = np.flatnonzero(~white & after) + 1
        self.of = np.searchsorted(self.starts, bounds)
        if hashes:
            size = self.ends - self.starts
            self.offset = np.cumsum(size) - size
            total, inner = int(size.sum()), data[~white]
            self.sums = sums = np.zeros(total + 1, np.uint64)
            cuts = np.unique(np.append(np.searchsorted(self.offset, np.arange(0, total, _SLICE)), len(size))).tolist()
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):  # of the arrays with a value for each byte, only the sums are whole
                low, high = int(self.offset[a]), int(self.offset[b - 1] + size[b - 1])
                place = np.arange(low, high) - np.repeat(self.offset[a:b], size[a:b])
                with np.errstate(over="ignore"):
                    value = _BYTE[(place & (_PLACES - 1)) << 8 | inner[low:high]]
                    far = np.flatnonzero(place >= _PLACES)
                    value[far] = mixed(value[far] + (place[far] // _PLACES).astype(np.uint64) * _ODD)
                    value[0] += sums[low]
                    np.cumsum(value, out=sums[low + 1 : high + 1])
            self.hashes = self.hashed(np.arange(len(size)), size)

    def hashed(self, which: np.ndarray, size: np.ndarray) -> np.ndarray:
        """A hash of the first ``size`` bytes of some words: a sum of random values, one for each place and byte."""
        at = self.offset[which]
        with np.errstate(over="ignore"):
            return mixed(self.sums[at + size] - self.sums[at] + size.astype(np.uint64) * _ODD)

    def inner(self) -> np.ndarray:
        """The words' bytes without what lies between them."""
        return self.data[~self.white]

    def grams(self, k: int) -> np.ndarray:
        """A hash of the k words from each word on, the last k - 1 words left out; grams may cross texts."""
        return grams(self.hashes, k)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64)
    up, down = powers(_Q, n + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * up[:n], out=sums[1:])
        return mixed((sums[k:] - sums[: n - k + 1]) * down[: n - k + 1])


# --- connected components ---------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for the nodes of ``edges (a, b)``; component is the smallest node that can be reached.

    Alternates large-star and small-star steps, each an aggregation with map-side combine and a join;
    every round is written to the shared folder. Loops, repeated and null edges are ignored.
    """
    e = stored(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:  # each round joins neighbouring stars: their number falls by a factor, and the last round changes nothing
        both = e.union(e.select("b", "a"))
        low = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, F.col("a") == F.col("u")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        joined = large.join(low, F.col("a") == F.col("u"))
        before, e = e, stored(joined.select("a", F.col("m").alias("b")).union(joined.where("b <> m").select("b", "m")).distinct(), "edges")
        dropped(before)
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == seen:
            break
        seen = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(e.select("b", "b").distinct())
