"""Repeated passages by compressed FM-indexes.

A window is ``WINDOW`` words; its anchor is the least hash of its runs of ``RUN`` words. A window can occur in another
document only if its anchor is an anchor there too. Such windows, cut into pieces by their anchors, go to shards by
anchor, so equal windows meet in one shard; equal pieces go there once, with their least document. A shard builds an FM-index over its
pieces (wavelet matrix of packed bits with block counts) and streams the pieces against it by backward search, all of
them in step; matching statistics are kept against documents with a smaller id, by range minima over the suffix order.
Intervals of at least ``WINDOW`` words are reported.

Words are compared by 64-bit hashes of their bytes.

Defined cases: null, empty and short texts have no windows; rows with equal ids and texts count as one document, and
texts that share an id, or have none, as several; a null id comes after all others; an empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, dropped, grams, steps, stored, text_batches, utf8

WINDOW, RUN = 50, 10
SPAN = WINDOW - RUN + 1  # runs in a window
SHARD_WORDS = 500_000


# --- the index ---------------------------------------------------------------------------------------------------


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """The suffixes' starts in order, by prefix doubling."""
    n = len(symbols)
    rank, step = symbols.astype(np.int64), 1
    while True:
        key = rank << 32
        key[: n - step] |= rank[step:] + 1
        order = np.argsort(key, kind="stable")
        rose = np.concatenate([[0], (np.diff(key[order]) != 0).cumsum()])
        rank = np.empty(n, np.int64)
        rank[order] = rose
        if n == 0 or rose[-1] == n - 1:
            return order
        step *= 2


_BELOW = (np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1)


class Wavelet:
    """A wavelet matrix: a level per bit of the symbols, bits packed in 64s with counts before each block."""

    def __init__(self, symbols: np.ndarray, top: int) -> None:
        self.levels = []
        for bit in range(max(1, int(top).bit_length()) - 1, -1, -1):
            ones = (symbols >> bit & 1).astype(bool)
            padded = np.zeros((len(ones) // 64 + 1) * 64, bool)
            padded[: len(ones)] = ones
            blocks = np.packbits(padded, bitorder="little").view(np.uint64)
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(blocks), dtype=np.int64)]).astype(np.int32)
            self.levels.append((bit, blocks, before, int(len(ones) - ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        self.first = np.zeros(top + 1, np.int64)  # where each symbol's occurrences start at the last level
        self.first = self.rank(np.arange(top + 1), np.zeros((1, top + 1), np.int64))[0]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place; ``symbol`` (n,), ``at`` (k, n)."""
        for bit, blocks, before, zeros in self.levels:
            block = at >> 6
            ones = before[block] + np.bitwise_count(blocks[block] & _BELOW[at & 63])
            at = np.where(symbol >> bit & 1, ones + zeros, at - ones)
        return at - self.first[symbol]


class RangeLeast:
    """Least value of any range, by a sparse table."""

    def __init__(self, values: np.ndarray) -> None:
        n = len(values)
        counts = [n - (1 << k) + 1 for k in range(max(1, n.bit_length()))]
        self.starts = np.concatenate([[0], np.cumsum(counts)])
        self.flat = np.empty(self.starts[-1], np.int32)
        row = self.flat[:n]
        row[:] = values
        for k in range(1, len(counts)):
            half, above = 1 << (k - 1), self.flat[self.starts[k] : self.starts[k + 1]]
            np.minimum(row[:-half], row[half:], out=above)
            row = above
        size = np.arange(len(values) + 1)
        self.log = np.zeros(len(values) + 1, np.int64)
        self.log[1:] = np.floor(np.log2(np.maximum(size[1:], 1))).astype(np.int64)

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        k = self.log[high - low]
        base = self.starts[k]
        return np.minimum(self.flat[base + low], self.flat[base + high - (1 << k)])


class Index:
    """An FM-index over texts of word hashes, each with an owner; searches ask for owners below one's own."""

    def __init__(self, texts: list[np.ndarray], owners: np.ndarray) -> None:
        lengths = np.array([len(t) for t in texts])
        self.known, coded = np.unique(np.concatenate(texts), return_inverse=True)
        self.ends = np.cumsum(lengths + 1)
        symbols = np.zeros(self.ends[-1], np.int64)  # 0 parts the texts
        inside = np.ones(len(symbols), bool)
        inside[self.ends - 1] = False
        symbols[inside] = coded + 1
        order = suffix_order(symbols)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=len(self.known) + 1))])
        self.wavelet = Wavelet(symbols[order - 1], len(self.known))
        self.least = RangeLeast(np.repeat(owners, lengths + 1)[order])
        self.size = len(symbols)

    def encode(self, text: np.ndarray) -> np.ndarray:
        """Symbols of a text; 0 for words that the index does not have."""
        at = np.minimum(np.searchsorted(self.known, text), len(self.known) - 1)
        return np.where(self.known[at] == text, at + 1, 0)

    def repeated(self, texts: list[np.ndarray], owners: np.ndarray, window: int = WINDOW) -> list[np.ndarray]:
        """For each text, which of its windows occur in a text with a smaller owner. All texts are searched in step.

        A search runs to the left as far as a smaller owner has the words. From the left, window by window: where a search
        fails at a place, every window over that place and its end fails, and the next starts behind it. When a window
        succeeds, those behind it are taken from the right: a match of a window's length or more decides all windows in
        it, a shorter one moves its right end by one; what is before the match is taken from the left again.
        """
        sizes = np.array([len(t) for t in texts])
        start = np.cumsum(sizes) - sizes
        text = self.encode(np.concatenate(texts))
        found = np.zeros(len(text), bool)  # by a window's first word
        alive = np.flatnonzero(sizes >= window)
        right = np.full(len(alive), window - 1)  # last word of the search
        left = np.zeros(len(alive), np.int64)  # first window to be decided
        stop = sizes[alive] - window  # last window to be decided
        forward = np.ones(len(alive), bool)
        at, low, high = right.copy(), np.zeros(len(alive), np.int64), np.full(len(alive), self.size)
        while len(alive):
            symbol = text[start[alive] + at]
            low2, high2 = self.wavelet.rank(symbol, np.stack([low, high])) + self.before[symbol]
            good = (symbol > 0) & (low2 < high2)
            good[good] = self.least(low2[good], high2[good]) < owners[alive[good]]
            low, high = np.where(good, low2, low), np.where(good, high2, high)
            reached = good & (at == left)
            at = np.where(good, at - 1, at)
            ended = ~good | reached
            if ended.any():
                first = at[ended] + 1  # first word of the match; at: where it failed
                last, go = right[ended], forward[ended]
                match = last - first + 1 >= window
                for k, f, e in zip(alive[ended][match], first[match], last[match], strict=True):
                    found[start[k] + f : start[k] + e - window + 2] = True
                turn = ~go & match
                stop[ended] = np.where(turn, first - 1, stop[ended])
                left[ended] = np.where(go, first, left[ended])
                left[ended] = np.where(go & match, first + 1, left[ended])
                forward[ended] = (go & ~match) | turn
                right[ended] = np.where(forward[ended], left[ended] + window - 1, np.where(go, stop[ended] + window - 1, last - 1))
                at[ended], low[ended], high[ended] = right[ended], 0, self.size
                done = ended & ((left > stop) | (right - window + 1 < left))
                if done.any():
                    keep = ~done
                    alive, right, left, stop, forward, at, low, high = (x[keep] for x in (alive, right, left, stop, forward, at, low, high))
        return [found[a : a + max(0, n - window + 1)] for a, n in zip(start.tolist(), sizes.tolist(), strict=True)]


# --- anchors and pieces ------------------------------------------------------------------------------------------


def _slid(x: np.ndarray, span: int, f) -> np.ndarray:
    """f over each ``span`` neighbours, by doubling."""
    reach = 1
    while reach < span:
        by = min(reach, span - reach)
        x = f(x[:-by], x[by:]) if len(x) > by else x[:0]
        reach += by
    return x


def anchors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one text's words: the runs' hashes, each window's least, and which runs are some window's least."""
    runs = grams(hashes, RUN)
    least = _slid(runs, SPAN, np.minimum)
    top = _slid(np.concatenate([np.zeros(SPAN - 1, np.uint64), least, np.zeros(SPAN - 1, np.uint64)]), SPAN, np.maximum)
    return runs, least, top == runs


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words]]:
    for batch in steps(batches):
        yield batch, Words(*utf8(batch.column(batch.schema.get_field_index("text"))))


def anchor_rows(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in _texts(batches):
            ids, own, hs, ps = [], [], [], []
            for i, h, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), words.of[:-1].tolist(), words.of[1:].tolist(), strict=True):
                if b - a >= WINDOW:
                    runs, _, chosen = anchors(words.hashes[a:b])
                    at = np.flatnonzero(chosen)
                    ids.append(np.full(len(at), i))
                    own.append(np.full(len(at), h))
                    hs.append(runs[at])
                    ps.append(at)
            if ids:
                yield pa.record_batch([pa.array(np.concatenate(ids), pa.int64()), pa.array(np.concatenate(own), pa.int64()), pa.array(np.concatenate(hs).view(np.int64)), pa.array(np.concatenate(ps), pa.int32())], ["doc_id", "h", "anchor", "at"])

    return docs.mapInArrow(run, "doc_id long, h long, anchor long, at int")


PIECES = "doc_id long, h long, first int, windows int, anchor long, hash binary, words binary"


def piece_rows(docs: DataFrame) -> DataFrame:
    """Pieces of ``docs (doc_id, h, text, shared)``; shared: places of anchors that other documents have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in _texts(batches):
            out = []
            for i, h, shared, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3), words.of[:-1].tolist(), words.of[1:].tolist(), strict=True):
                if b - a < WINDOW:
                    continue
                own = words.hashes[a:b]
                runs, least, _ = anchors(own)
                open_ = np.isin(least, runs[shared.values.to_numpy()])
                at = np.flatnonzero(open_)
                if not len(at):
                    continue
                cut = np.flatnonzero((np.diff(at) != 1) | (least[at][1:] != least[at][:-1])) + 1
                for piece in np.split(at, cut):
                    s, n = int(piece[0]), len(piece)
                    data = own[s : s + n + WINDOW - 1].tobytes()
                    out.append((i, h, s, n, int(least[s].astype(np.int64)), xxhash.xxh3_128_digest(data), data))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], [x.split()[0] for x in PIECES.split(", ")])

    return docs.mapInArrow(run, PIECES)


def _search(table: pa.Table) -> pa.Table:
    """One shard: an index over its pieces, then all of them against it."""
    texts = [np.frombuffer(x, np.uint64) for x in table["words"].to_pylist()]
    owners = np.unique(np.stack([table["owner"].to_numpy(), table["owner_h"].to_numpy()], 1), axis=0, return_inverse=True)[1].reshape(-1)
    found = Index(texts, owners).repeated(texts, owners) if texts else []
    return pa.table({"hash": table["hash"], "owner": table["owner"], "owner_h": table["owner_h"], "found": pa.array([np.packbits(f, bitorder="little").tobytes() for f in found], pa.binary())})


def repeated_passages(docs: DataFrame, doc: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (and the kept text)."""
    spark = docs.sparkSession
    text_batches(spark)
    docs = docs.select(F.coalesce(F.col(doc).cast("long"), F.lit((1 << 63) - 1)).alias("doc_id"), F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("text"))  # id and text are the document
    one = F.struct("doc_id", "h")
    rows = stored(anchor_rows(docs), "anchors")
    shared = stored(rows.groupBy("anchor").agg(F.min(one).alias("a"), F.max(one).alias("b")).where("a < b").select("anchor"), "shared")  # a table, so that AQE can split an anchor that many documents have
    places = stored(rows.join(shared, "anchor").groupBy("doc_id", "h").agg(F.array_distinct(F.collect_list("at")).alias("shared")), "places")
    dropped(rows, shared)
    pieces = stored(piece_rows(docs.join(places, ["doc_id", "h"]).select("doc_id", "h", "text", "shared")), "pieces")
    dropped(places)
    # hash decides the content; equal pieces go to the index once
    once = stored(pieces.groupBy("hash").agg(F.min(one).alias("o"), F.first("anchor").alias("anchor"), F.first("words").alias("words")).select("hash", F.col("o.doc_id").alias("owner"), F.col("o.h").alias("owner_h"), "anchor", "words"), "once")
    slim = stored(pieces.select("hash", "doc_id", "h", "first", "windows"), "slim")  # the words are in `once`
    dropped(pieces)
    total = once.agg(F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()[0] // 8
    shards = max(1, -(-total // SHARD_WORDS))
    found = once.select("hash", "owner", "owner_h", "words", F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard")).groupBy("shard").applyInArrow(_search, "hash binary, owner long, owner_h long, found binary")
    found = stored(found, "found")
    dropped(once)
    spans = slim.join(found, "hash").select("doc_id", "h", F.struct("first", "windows", F.when((F.col("doc_id") == F.col("owner")) & (F.col("h") == F.col("owner_h")), F.col("found")).alias("found")).alias("span"))
    spans = spans.groupBy("doc_id", "h").agg(F.collect_list("span").alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            data, bounds = utf8(batch.column(1))
            words = Words(data, bounds, hashes=False)
            out = []
            for k, (i, spans_, a, b) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), words.of[:-1].tolist(), words.of[1:].tolist(), strict=True)):
                edge = np.zeros(b - a + 1, np.int32)
                for span in spans_ or ():
                    s, n = span["first"], span["windows"]
                    if span["found"] is None:
                        edge[s] += 1
                        edge[s + n + WINDOW - 1] -= 1
                    else:
                        at = s + np.flatnonzero(np.unpackbits(np.frombuffer(span["found"], np.uint8), count=n, bitorder="little"))
                        np.add.at(edge, at, 1)
                        np.add.at(edge, at + WINDOW, -1)
                gone = np.cumsum(edge[:-1]) > 0
                parts = data[bounds[k] : bounds[k + 1]].tobytes().split()
                kept = b" ".join(p for p, g in zip(parts, gone.tolist(), strict=True) if not g) if gone.any() else b" ".join(parts)
                out.append((i, b - a, int(gone.sum()), hashlib.sha256(kept).hexdigest(), *([kept.decode()] if with_text else [])))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), *[pa.string()] * with_text]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "n_words", "n_removed", "kept_sha256", *["kept"] * with_text])

    done = docs.join(spans, ["doc_id", "h"], "left").select("doc_id", "text", "spans").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text)
    return done.withColumn("doc_id", F.nullif("doc_id", F.lit((1 << 63) - 1)))
