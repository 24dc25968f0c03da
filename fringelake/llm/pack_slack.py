"""Packing by minimum bin slack.

Documents are token ids with an end id; full windows of ``capacity`` ids are cut off first. What remains of each
document is packed: the longest piece opens a window, and a subset-sum programme over bitsets finds the multiset of
remaining lengths that fills the window closest to its capacity. The choice is read back from the stored bitsets with
its counts, and repeated as long as the counts last.

Every input partition packs by itself, in groups of at most ``GROUP`` pieces, so memory is bounded, nothing is
shuffled, and a lost task is simply run again. One window of each group may stay short.

Defined cases: null and empty texts are the end id alone; null and repeated ids are packed row by row; an empty table
gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import steps, text_batches, utf8
from .tokens import STEP, tokens_of

CAPACITY = 2048
GROUP = 200_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def fill(room: int, counts: dict[int, int]) -> dict[int, int]:
    """The multiset within ``counts`` (length -> number) whose sum is nearest ``room`` from below; longer lengths first."""
    mask, bits, done = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, part = counts[length], 1
        while left and part * length <= room and not bits >> room & 1:
            many = min(part, left)
            done.append((length, many, bits))
            bits |= bits << (many * length) & mask
            left, part = left - many, part * 2
        if bits >> room & 1:
            break
    at, used = bits.bit_length() - 1, Counter()
    for length, many, before in reversed(done):
        if not before >> at & 1:
            used[length] += many
            at -= many * length
    return dict(used)


def patterns(counts: dict[int, int], capacity: int = CAPACITY) -> Iterator[tuple[dict[int, int], int]]:
    """(multiset of lengths, times it is used) until nothing remains."""
    left = {k: v for k, v in counts.items() if v}
    while left:
        top = max(left)
        left[top] -= 1
        use = fill(capacity - top, {k: v for k, v in left.items() if v})
        left[top] += 1
        use[top] = use.get(top, 0) + 1
        times = min(left[k] // v for k, v in use.items())
        for k, v in use.items():
            left[k] -= v * times
            if not left[k]:
                del left[k]
        yield use, times


def _packed(rows: list[tuple], rest: list[tuple], first: int, capacity: int) -> tuple[list[tuple], int]:
    by = defaultdict(list)
    for r in rest:
        by[r[2]].append(r)
    out, at = [(*r, first + i, 0) for i, r in enumerate(rows)], first + len(rows)
    for use, times in patterns({k: len(v) for k, v in by.items()}, capacity):
        for _ in range(times):
            offset = 0
            for length, many in use.items():
                for _ in range(many):
                    out.append((*by[length].pop(), at, offset))
                    offset += length
            at += 1
    return out, at


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, doc: str = "doc_id", text: str = "text", group: int = GROUP) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, full, rest = TaskContext.get().partitionId() << 40, [], []
        names = [x.split()[0] for x in SCHEMA.split(", ")]

        def flush() -> pa.RecordBatch:
            nonlocal at, full, rest
            out, at = _packed(full, rest, at, capacity)
            full, rest = [], []
            return pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)

        for batch in steps(batches, size=STEP):
            ids, bounds = tokens_of(path).encode(*utf8(batch.column(1)))
            ids = ids.astype("<u4")
            for doc_id, a, b in zip(batch.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                for s in range(a, b, capacity):
                    e = min(s + capacity, b)
                    (full if e - s == capacity else rest).append((doc_id, s - a, e - s, zlib.crc32(ids[s:e]), b - a))
                if len(full) + len(rest) >= group:
                    yield flush()
        if full or rest:
            yield flush()

    return docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SCHEMA)
