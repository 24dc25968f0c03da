"""Line dedup by content-defined chunks.

A text's lines are hashed, and a rolling hash over neighbouring line hashes says where chunks end, so boundaries shift
with the content and not with its place. Chunks of two lines or more that occur more than once in the corpus are
removed, but for the first occurrence (least document id, then place). Occurrences are found by a 128-bit hash in two
halves, and every chunk whose hash repeats is then grouped by its own bytes. Where one first half stands for several
chunks, the second tells them apart; a whole hash that stood for several texts would remove nothing.

Defined cases: null stays null and has no lines; one-line chunks and empty texts stay; rows with the same id and text
keep and lose the same chunks; texts that share an id, or have none, are documents of their own; a null id comes last;
very long texts are rows like others; an empty table gives no rows; all other columns are passed on, whatever their
names, but for one that has the result's name, which is replaced.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, small_side, steps, stored, text_batches

CUT, LEAST, MOST = 4, 2, 16  # one end in CUT lines on average; lines of a chunk
_LAST = (1 << 63) - 1


def chunks(text: str) -> list[list[str]]:
    """The text's lines in chunks. A chunk ends where the hash of its last two lines says so, or at MOST lines."""
    lines = text.split("\n")
    hashes = [xxhash.xxh3_64_intdigest(x.encode()) for x in lines]
    out, first = [], 0
    for i in range(len(lines)):
        n = i + 1 - first
        if n >= MOST or n >= LEAST and (hashes[i - 1] * 31 + hashes[i] >> 7) % CUT == 0:
            out.append(lines[first : i + 1])
            first = i + 1
    if first < len(lines):
        out.append(lines[first:])
    return out


NAMES = ["hash", "check", "k", "h", "place", "chunk"]
KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string()]


def chunk_rows(docs: DataFrame, with_text: bool) -> DataFrame:
    """(hash, check, k, h, place[, chunk]) of every chunk of two lines or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            out = []
            for k, h, text in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                if text and "\n" in text:
                    for place, lines in enumerate(chunks(text)):
                        if len(lines) >= LEAST:
                            chunk = "\n".join(lines)
                            both = xxhash.xxh3_128_digest(chunk.encode())
                            out.append((*struct.unpack("<qq", both), k, h, place, chunk))
            if out:
                columns = list(zip(*out, strict=True))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, KINDS, strict=True)][: 5 + with_text], NAMES[: 5 + with_text])

    return docs.mapInArrow(run, "hash long, check long, k long, h long, place int" + ", chunk string" * with_text)


@F.pandas_udf(T.StructType().add("kept", T.StringType()).add("n_lines", T.LongType()).add("n_chunks", T.LongType()).add("n_removed", T.LongType()))
def without(texts: pd.Series, gone: pd.Series) -> pd.DataFrame:
    out = []
    for text, drop in zip(texts, gone, strict=True):
        if text is None:
            out.append((None, 0, 0, 0))
            continue
        parts = chunks(text)
        drop = set() if drop is None else set(np.asarray(drop).tolist())
        n = sum(map(len, parts))
        kept = [x for i, p in enumerate(parts) if i not in drop for x in p]
        out.append(("\n".join(kept) if drop else text, n, len(parts), n - len(kept)))
    return pd.DataFrame(out, columns=["kept", "n_lines", "n_chunks", "n_removed"])


def line_dedup(docs: DataFrame, doc: str = "doc_id", text: str = "text", result: str = "_cut") -> DataFrame:
    """``docs`` with a struct column ``result``: kept, n_lines, n_chunks, n_removed (lines)."""
    text_batches(docs.sparkSession)
    key = F.coalesce(F.col(doc).cast("long"), F.lit(_LAST))
    own = F.xxhash64(F.col(text))
    slim = docs.select(key.alias("k"), own.alias("h"), F.col(text).alias("text"))
    rows = stored(chunk_rows(slim, False), "chunks")
    both = ["hash", "check"]
    often = rows.groupBy(*both).agg(F.count("*").alias("n")).where("n > 1").select(*both)
    texts = chunk_rows(slim, True).join(small_side(often), both, "left_semi")
    same = texts.groupBy(*both, "chunk").agg(F.min(F.struct("k", "h", "place")).alias("first"), F.count("*").alias("n"))  # bytes decide
    repeated = same.groupBy(*both).agg(F.count("*").alias("texts"), F.min("first").alias("first"), F.max("n").alias("n")).where("texts = 1 and n > 1").select(*both, "first")
    gone = rows.join(repeated, both).where("not (k = first.k and h = first.h and place = first.place)").groupBy("k", "h").agg(F.collect_set("place").alias("gone"))
    docs = docs.drop(result)
    k, h, places = (free_name(docs, name) for name in ("_k", "_h", "_gone"))
    joined = docs.withColumns({k: key, h: own}).join(gone.withColumnsRenamed({"k": k, "h": h, "gone": places}), [k, h], "left")
    return joined.withColumn(result, without(F.col(text), F.col(places))).drop(k, h, places)
