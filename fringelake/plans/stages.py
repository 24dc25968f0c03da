"""Processing chains: named stages whose outputs are tables; a stage whose output is there is skipped.

A stage is (name, function); a function takes the runner and returns a DataFrame, and reads earlier outputs by
``runner.table(name)``. ``first`` starts in the middle, ``leave_out`` skips stages by name, and every run writes down what
it did with which settings. Tiers are sets of settings.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: What the tiers stand for.
TIERS = {
    "FAST": {"decimation": 16, "tiles": (2, 2), "processes": 4, "search": 64, "patches": (5, 10), "snr": 8},
    "STANDARD": {"decimation": 2, "tiles": (2, 2), "processes": 4, "search": 128, "patches": (100, 50), "snr": 15},
    "QUALITY": {"decimation": 8, "tiles": (3, 3), "processes": 4, "search": 256, "patches": (200, 50), "snr": 20},
}


def tier(name: str, memory_gb: float | None = None) -> dict:
    """A tier's settings; with less than 16 GB the fast one, at a decimation of 4."""
    if memory_gb is not None and memory_gb < 16:
        return TIERS["FAST"] | {"decimation": 4}
    return TIERS[name.upper()]


def settings(lines: list[str]) -> dict[str, str]:
    """``key = value`` lines; what follows # is left out, the last of a key wins."""
    out = {}
    for line in lines:
        key, found, value = line.partition("#")[0].partition("=")
        if found:
            out[key.strip()] = value.strip()
    return out


class Runner:
    def __init__(self, spark: SparkSession, folder: str, options: dict | None = None) -> None:
        self.spark, self.folder, self.options, self.log = spark, folder.rstrip("/"), options or {}, []

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def done(self, name: str) -> bool:
        """A table counts only if its write was finished."""
        path, fs = self._path(f"{name}/_SUCCESS")
        return fs.exists(path)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def run(self, stages: list[tuple[str, Callable[[Runner], DataFrame]]], first: str | None = None, leave_out: tuple[str, ...] = (), again: bool = False) -> list[tuple[str, str]]:
        names = [n for n, _ in stages]
        begin = names.index(first) if first else 0
        for k, (name, stage) in enumerate(stages):
            if k < begin or name in leave_out:
                self.log.append((name, "left out"))
            elif self.done(name) and not again:
                self.log.append((name, "there"))
            else:
                stage(self).write.mode("overwrite").parquet(f"{self.folder}/{name}")
                self.log.append((name, "made"))
        rows = [(i, n, what, json.dumps(self.options, sort_keys=True)) for i, (n, what) in enumerate(self.log)]
        self.spark.createDataFrame(rows, "k int, stage string, what string, options string").coalesce(1).write.mode("overwrite").json(f"{self.folder}/_lineage")
        return self.log

    def batch(self, items: DataFrame, stages: Callable[[str], list], key: str) -> dict[str, list[tuple[str, str]]]:
        """One chain per row of a short list, each in a folder of its own."""
        out = {}
        for r in items.select(key).distinct().orderBy(key).collect():  # a list of scenes or pairs
            out[str(r[0])] = Runner(self.spark, f"{self.folder}/{r[0]}", self.options).run(stages(str(r[0])))
        return out

    def clean(self, *names: str) -> None:
        for name in names:
            path, fs = self._path(name)
            fs.delete(path, True)
