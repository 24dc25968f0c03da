"""Readers and writers of scene files: fixed records, complex images, strips of TIFF, orbits, tables, delay grids.

Files come as rows of Spark's binary and text sources, so they may lie in any store that Spark reads; each file is cut
into rows by numpy in one Arrow pass, and only the columns asked for are made.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ARROW = {"i2": (pa.int32(), "int"), "i4": (pa.int32(), "int"), "i8": (pa.int64(), "long"), "u1": (pa.int32(), "int"), "f4": (pa.float32(), "float"), "f8": (pa.float64(), "double")}
STEP = 1 << 18  # rows of an output batch


def fixed_records(spark: SparkSession, paths: str | list[str], fields: list[tuple[str, str]], columns: list[str] | None = None, skip: int = 0, prefix: int = 0, order: str = "<") -> DataFrame:
    """Records of ``fields`` (name, numpy kind such as ``f8``) after ``skip`` bytes, each behind ``prefix`` bytes: file, i, columns."""
    names = columns or [n for n, _ in fields]
    kinds = dict(fields)
    dtype = np.dtype([("_", f"V{prefix}")] * bool(prefix) + [(n, order + k) for n, k in fields])
    schema = "file string, i long, " + ", ".join(f"{n} {_ARROW[kinds[n]][1]}" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = np.frombuffer(content, dtype, (len(content) - skip) // dtype.itemsize, skip)
                for a in range(0, len(data), STEP):
                    part = data[a : a + STEP]
                    own = [pa.array(part[n].astype(kinds[n].replace("i2", "i4").replace("u1", "i4")), _ARROW[kinds[n]][0]) for n in names]
                    yield pa.record_batch([pa.array([path] * len(part)), pa.array(np.arange(a, a + len(part))), *own], ["file", "i", *names])

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInArrow(run, schema)


def read_transform(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Five doubles a point: rng, azi, topo, lon, lat."""
    return fixed_records(spark, paths, [(n, "f8") for n in ("rng", "azi", "topo", "lon", "lat")])


def read_image(spark: SparkSession, paths: str | list[str], width: int) -> DataFrame:
    """A headerless complex image of 16-bit pairs: file, r, c, re, im."""
    pairs = fixed_records(spark, paths, [("re", "i2"), ("im", "i2")])
    return pairs.select("file", F.floor(F.col("i") / width).alias("r"), (F.col("i") % width).alias("c"), "re", "im")


def tiff_pixels(content: bytes) -> np.ndarray:
    """The samples of an uncompressed TIFF in strips: (rows, columns), complex for pairs of 16 bits."""
    order = {b"II": "<", b"MM": ">"}[content[:2]]
    at = struct.unpack_from(order + "I", content, 4)[0]
    tags = {}
    for k in range(struct.unpack_from(order + "H", content, at)[0]):
        tag, kind, n = struct.unpack_from(order + "HHI", content, at + 2 + 12 * k)
        code, size = {1: ("B", 1), 3: ("H", 2), 4: ("I", 4)}.get(kind, ("B", 1))
        where = at + 10 + 12 * k
        if n * size > 4:
            where = struct.unpack_from(order + "I", content, where)[0]
        tags[tag] = struct.unpack_from(f"{order}{n}{code}", content, where)
    if tags.get(259, (1,))[0] != 1:
        raise ValueError("only uncompressed strips are read")
    width, height, bits, per, form = tags[256][0], tags[257][0], tags[258][0], tags.get(277, (1,))[0], tags.get(339, (1,))[0]
    data = b"".join(content[a : a + n] for a, n in zip(tags[273], tags[279], strict=True))
    if form == 5 or per == 2:  # complex integers, or two samples
        pairs = np.frombuffer(data, order + ("i2" if bits in (16, 32) else "f4")).reshape(height, width, 2)
        return pairs[..., 0] + 1j * pairs[..., 1]
    return np.frombuffer(data, order + {1: "u", 2: "i", 3: "f"}[form] + str(bits // 8)).reshape(height, width)


def read_tiff(spark: SparkSession, paths: str | list[str], multiple: int = 4) -> DataFrame:
    """Complex pixels of TIFF images, trimmed to a width that is a multiple of ``multiple``: file, r, c, re, im."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                z = tiff_pixels(content)
                z = z[:, : z.shape[1] // multiple * multiple]
                for r in range(len(z)):
                    n = z.shape[1]
                    yield pa.record_batch([pa.array([path] * n), pa.array(np.full(n, r)), pa.array(np.arange(n)), pa.array(z[r].real.astype(float)), pa.array(z[r].imag.astype(float))], ["file", "r", "c", "re", "im"])

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInArrow(run, "file string, r long, c long, re double, im double")


def tiff_bytes(z: np.ndarray, missing: float = -9999.0) -> bytes:
    """A one-strip TIFF of 32-bit floats; missing cells become ``missing``, which the file names."""
    data = np.where(np.isnan(z), missing, z).astype("<f4").tobytes()
    text = f"{missing:g}\0".encode().ljust(8, b"\0")
    entries = [(256, 4, 1, z.shape[1]), (257, 4, 1, z.shape[0]), (258, 3, 1, 32), (259, 3, 1, 1), (262, 3, 1, 1), (273, 4, 1, 0), (277, 3, 1, 1), (278, 4, 1, z.shape[0]), (279, 4, 1, len(data)), (339, 3, 1, 3), (42113, 2, len(text), 0)]
    start = 8 + 2 + 12 * len(entries) + 4
    fixed = {42113: start, 273: start + len(text)}
    head = struct.pack("<2sHIH", b"II", 42, 8, len(entries)) + b"".join(struct.pack("<HHII", t, k, n, fixed.get(t, v)) for t, k, n, v in entries) + struct.pack("<I", 0)
    return head + text + data


def read_orbit(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Orbit files: a header ``nd yr jd sec dsec``, then nd rows; the time of row k is 86400 jd + sec + k dsec: file, k, yr, t, x..vz."""
    lines = spark.read.text(paths, wholetext=True).select(F.input_file_name().alias("file"), F.split(F.trim("value"), r"\r?\n").alias("l"))
    head = F.split(F.trim(F.get("l", F.lit(0))), r"\s+")
    rows = lines.select("file", head.alias("h"), F.posexplode(F.slice("l", 2, 1 << 30)).alias("k", "line")).where(F.col("k") < F.get("h", F.lit(0)).cast("int"))
    part = F.split(F.trim("line"), r"\s+")
    t = F.get("h", F.lit(2)).cast("double") * 86400 + F.get("h", F.lit(3)).cast("double") + F.col("k") * F.get("h", F.lit(4)).cast("double")
    return rows.select("file", "k", F.get("h", F.lit(1)).cast("int").alias("yr"), t.alias("t"), *[F.get(part, F.lit(i + 3)).cast("double").alias(n) for i, n in enumerate(("x", "y", "z", "vx", "vy", "vz"))])


def write_orbit(states: DataFrame, path: str, step: float, by: str = "scene", millis: int = 3) -> None:
    """One orbit file per scene of ``states (scene, k, yr, jd, sec, x, y, z, vx, vy, vz)``; times are rounded to ``millis`` digits."""
    row = F.format_string("%d %d %." + str(millis) + "f %.6f %.6f %.6f %.8f %.8f %.8f", F.col("yr").cast("int"), F.col("jd").cast("int"), F.round(F.col("sec") + F.col("k") * step, millis), "x", "y", "z", "vx", "vy", "vz")
    lines = states.groupBy(by).agg(F.sort_array(F.collect_list(F.struct("k", row.alias("line")))).alias("l"), F.min_by(F.struct("yr", "jd", "sec"), "k").alias("f"), F.count("*").alias("n"))
    head = F.format_string("%d %d %d %.6f %.6f", "n", F.col("f.yr").cast("int"), F.col("f.jd").cast("int"), F.col("f.sec").cast("double"), F.lit(float(step)))
    lines.select(by, F.concat_ws("\n", head, F.array_join(F.transform("l", lambda s: s["line"]), "\n")).alias("value")).write.partitionBy(by).text(path)


def read_table(spark: SparkSession, path: str, names: list[str], count: int | None = None) -> DataFrame:
    """Rows of blank-separated fields by place; another number of rows than ``count`` is an error."""
    part = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where(F.trim("value") != "").select(*[F.get(part, F.lit(i)).alias(n) for i, n in enumerate(names)])
    if count is not None and (n := rows.count()) != count:
        raise ValueError(f"{path}: {n} rows, {count} expected")
    return rows


def read_delay(spark: SparkSession, path: str, step: float = 1 / 1200) -> DataFrame:
    """A delay grid ``.ztd`` with its ``.rsc``: lat, lon, z; zero is missing."""
    keys = {r.value.split()[0]: r.value.split()[1] for r in spark.read.text(path + ".rsc").collect() if len(r.value.split()) > 1}  # a header of some lines
    width, x0, y0 = int(keys["WIDTH"]), float(keys["X_FIRST"]), float(keys["Y_FIRST"])
    cells = fixed_records(spark, path, [("z", "f4")])
    return cells.select((F.lit(y0) - F.floor(F.col("i") / width) * step).alias("lat"), (F.lit(x0) + F.col("i") % width * step).alias("lon"), F.nullif("z", F.lit(0).cast("float")).alias("z"))


def write_points(cells: DataFrame, path: str) -> None:
    """``x y z`` lines of the known cells."""
    cells.where("z is not null").select(F.concat_ws(" ", F.col("c").cast("string"), F.col("r").cast("string"), F.col("z").cast("string")).alias("value")).write.text(path)


def read_points(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, ["c", "r", "z"]).select(F.col("r").cast("long"), F.col("c").cast("long"), F.col("z").cast("double"))


def write_grid(cells: DataFrame, path: str, title: str, remark: str, command: str) -> None:
    """Cells as Parquet whose column metadata say where they come from."""
    told = {"title": title, "remark": remark, "command": command}
    cells.withMetadata("z", told).write.parquet(path)
