"""A Python data source for headerless complex images, and a table function that cuts key-value texts into rows.

``spark.dataSource.register(ImageSource)``, then ``spark.read.format("slc").option("width", 512).option("rows", 2048).load(path)``:
a partition is a band of lines, and reads its own bytes only. The path has to be one that Python opens on every executor.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.functions import udtf


class Band(InputPartition):
    def __init__(self, first: int, last: int) -> None:
        self.first, self.last = first, last


class ImageReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.width, self.rows, self.band = options["path"], int(options["width"]), int(options["rows"]), int(options.get("band", 512))

    def partitions(self) -> list[Band]:
        return [Band(a, min(self.rows, a + self.band)) for a in range(0, self.rows, self.band)]

    def read(self, partition: Band) -> Iterator:
        import numpy as np
        import pyarrow as pa

        with open(self.path, "rb") as f:
            f.seek(partition.first * self.width * 4)
            data = np.frombuffer(f.read((partition.last - partition.first) * self.width * 4), "<i2").reshape(-1, 2).astype(np.int32)
        at = np.arange(len(data)) + partition.first * self.width
        yield pa.record_batch([pa.array(at // self.width), pa.array(at % self.width), pa.array(data[:, 0]), pa.array(data[:, 1])], ["r", "c", "re", "im"])


class ImageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "slc"

    def schema(self) -> str:
        return "r long, c long, re int, im int"

    def reader(self, schema) -> ImageReader:
        return ImageReader(self.options)


class _Pairs:
    def eval(self, text: str):
        for k, line in enumerate((text or "").splitlines()):
            key, found, value = line.partition("=")
            if found and "#" not in line:
                yield k, key.strip(), value.strip()


def pairs_function():
    """A table function (text) -> (ord, key, value); made where a session is there."""
    return udtf(_Pairs, returnType="ord int, key string, value string")
