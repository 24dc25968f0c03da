"""Token ids in a binary format compressed by Re-Pair.

Documents are dealt into ranges of ascending ids; each range is a shard, written as blocks of about ``BLOCK`` ids. In a
block, the most frequent pairs of neighbouring symbols become nonterminals, ``RULES`` at a time, again and again until no
pair occurs twice or the format's 65,536 symbols are used up; pairs never reach across documents. A block stores its
rules, every symbol's expansion length, and each document's place, so any slice of any document is decoded without the rest.

A payload: ``FORMAT`` header (the first nonterminal, which is the vocabulary's size; counts), then rules (pairs of u16), expansion lengths (u32), document ids (i64) with a
null mask (u8), symbol bounds (u32), id counts (u32) and the symbols (u16), all little-endian.

Defined cases: null and empty texts are the end id alone; null ids come first; rows with the same id follow one another
by text; an empty table gives no blocks; other columns of the input are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import steps, text_batches, utf8
from .tokens import STEP, tokens_of

BLOCK, RULES, LEAST = 1 << 20, 4096, 2  # ids of a block; pairs replaced at a time; occurrences that make a pair worth a rule
SYMBOLS = 1 << 16
ACROSS = np.uint32(0xFFFFFFFF)  # in place of a pair across documents; symbol 65,535 is the last one, so it is in no pair
SLOTS = 18  # bits of a hash of chosen pairs
SHORT = 64  # ids of a rule up to which its expansion is kept
FORMAT = "<8sIIII"
MAGIC = b"FLRP0002"
BLOCKS = "shard int, block int, first_id long, n_ids long, payload binary"


def counted(pair: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs that occur ``least`` times or more, ascending, and how often they do."""
    order = np.sort(pair)
    ends = np.append(np.flatnonzero(order[1:] != order[:-1]), len(order) - 1)
    n = np.diff(ends, prepend=-1)
    often = np.flatnonzero(n >= least)
    found, n = order[ends[often]], n[often]
    return (found[:-1], n[:-1]) if len(found) and found[-1] == ACROSS else (found, n)


def located(pair: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``pair`` is one of the ascending ``keys``, and which: by a table of hashes, where two keys share a slot by search."""
    table = np.full(1 << SLOTS, -1, np.int32)
    spread, low = np.uint32(0x9E3779B1), np.uint32(32 - SLOTS)
    table[keys * spread >> low] = np.arange(len(keys))
    at = table[pair * spread >> low]
    spots = np.flatnonzero(at >= 0)
    at, there = at[spots], pair[spots]
    other = np.flatnonzero(keys[at] != there)
    near = np.minimum(np.searchsorted(keys, there[other]), len(keys) - 1)
    at[other] = np.where(keys[near] == there[other], near, -1)
    return spots[at >= 0], at[at >= 0]


def compress(ids: np.ndarray, bounds: np.ndarray, first: int, rules: int = RULES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, their bounds by document, the rules (left, right), and the length that each rule expands to."""
    seq = ids.astype(np.uint16)
    opens = np.zeros(len(seq) + 1, bool)
    opens[bounds] = True
    made: list[np.ndarray] = []
    lengths = [np.ones(first, np.int64)]
    top = first
    while True:
        room = min(rules, SYMBOLS - top)
        if len(seq) < 2 or room <= 0:
            break
        pair = seq[:-1].astype(np.uint32) << np.uint32(16) | seq[1:]
        pair[opens[1 : len(seq)]] = ACROSS
        keys, n = counted(pair, LEAST)
        if not len(keys):
            break
        if len(keys) > room:
            often = np.flatnonzero(n >= np.partition(n, -room)[-room])
            often = np.sort(often[np.lexsort((keys[often], -n[often]))[:room]])
            keys, n = keys[often], n[often]
        best = np.lexsort((keys, -n))
        number = np.empty(len(keys), np.int64)
        number[best] = np.arange(len(keys))
        spots, rule = located(pair, keys)
        rule = number[rule]
        run = np.concatenate([[True], np.diff(spots) != 1])  # overlapping pairs: every second one of a run holds
        into = np.arange(len(spots)) - np.maximum.accumulate(np.where(run, np.arange(len(spots)), 0))
        spots, rule = spots[into % 2 == 0], rule[into % 2 == 0]
        made.append(np.stack([keys[best] >> np.uint32(16), keys[best] & np.uint32(0xFFFF)], 1).astype(np.uint16))
        known = np.concatenate(lengths)
        lengths.append(known[made[-1][:, 0]] + known[made[-1][:, 1]])
        seq[spots] = top + rule
        keep = np.ones(len(seq), bool)
        keep[spots + 1] = False
        seq, opens = seq[keep], np.append(opens[:-1][keep], True)
        top += len(best)
    # empty documents do not occur: each has its end id
    return seq, np.flatnonzero(opens), np.concatenate(made) if made else np.zeros((0, 2), np.uint16), np.concatenate(lengths)[first:]


def to_bytes(doc_ids: list, ids: np.ndarray, bounds: np.ndarray, first: int) -> bytes:
    symbols, places, rules, lengths = compress(ids, bounds, first)
    null = np.array([d is None for d in doc_ids], np.uint8)
    return b"".join([
        struct.pack(FORMAT, MAGIC, first, len(rules), len(doc_ids), len(symbols)), rules.astype("<u2").tobytes(), lengths.astype("<u4").tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        null.tobytes(), places.astype("<u4").tobytes(), np.diff(bounds).astype("<u4").tobytes(), symbols.astype("<u2").tobytes(),
    ])


class Block:
    """A payload, opened for reading."""

    def __init__(self, payload: bytes) -> None:
        magic, self.first, n_rules, n_docs, n_symbols = struct.unpack_from(FORMAT, payload)
        if magic != MAGIC:
            raise ValueError("not a block of this format")
        at = struct.calcsize(FORMAT)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(payload, kind, n, at)
            at += got.nbytes
            return got

        self.rules = take("<u2", 2 * n_rules).reshape(-1, 2)
        self.lengths = np.concatenate([np.ones(self.first, np.int64), take("<u4", n_rules)])
        ids, null = take("<i8", n_docs), take("u1", n_docs)
        self.doc_ids = [None if z else d for d, z in zip(ids.tolist(), null.tolist(), strict=True)]
        self.places, self.counts, self.symbols = take("<u4", n_docs + 1), take("<u4", n_docs), take("<u2", n_symbols)

    def unfolded(self, seq: np.ndarray, short: int) -> np.ndarray:
        """``seq`` with nonterminals of more than ``short`` ids replaced until none is left, at most once per round of rules."""
        while (deep := self.lengths[seq] > short).any():
            size = np.where(deep, 2, 1)
            ends = np.cumsum(size)
            out = np.empty(ends[-1], np.int64)
            out[(ends - 1)[~deep]] = seq[~deep]
            pair = self.rules[seq[deep] - self.first]
            out[(ends - 2)[deep]], out[(ends - 1)[deep]] = pair[:, 0], pair[:, 1]
            seq = out
        return seq

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids that symbols stand for; where they are many, short rules are expanded once for all."""
        seq = symbols.astype(np.int64)
        if len(seq) <= len(self.rules):
            return self.unfolded(seq, 1).astype(np.uint32)
        seq = self.unfolded(seq, SHORT)
        known = np.flatnonzero(self.lengths <= SHORT)
        size = np.where(self.lengths <= SHORT, self.lengths, 0)
        start = np.cumsum(size) - size
        flat = self.unfolded(known, 1).astype(np.uint32)
        size = size[seq]
        ends = np.cumsum(size)
        return flat[np.repeat(start[seq] - ends + size, size) + np.arange(ends[-1])]

    def ids(self, doc: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids start to stop of a document; only the symbols that cover them are expanded."""
        own = self.symbols[self.places[doc] : self.places[doc + 1]]
        ends = np.cumsum(self.lengths[own])
        stop = int(ends[-1]) if stop is None else min(stop, int(ends[-1]))
        if start >= stop:
            return np.zeros(0, np.uint32)
        a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
        skipped = int(ends[a - 1]) if a else 0
        return self.expand(own[a:b])[start - skipped : stop - skipped]


def encode(docs: DataFrame, path: str, doc: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """Blocks of all documents in ascending order of ids: shard, block, first_id (in the shard), n_ids, payload."""
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, first = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, first, held, size
            ids = np.concatenate([x[1] for x in held])
            bounds = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(x[2]) for x in held]))])
            row = [shard, number, first, len(ids), to_bytes([d for x in held for d in x[0]], ids, bounds, tokens_of(path).size)]
            number, first, held, size = number + 1, first + len(ids), [], 0
            return pa.record_batch([pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["shard", "block", "first_id", "n_ids", "payload"])

        for batch in steps(batches, size=STEP):
            ids, bounds = tokens_of(path).encode(*utf8(batch.column(1)))
            names, a = batch.column(0).to_pylist(), 0
            while a < len(names):  # documents until the block is full; one document at least
                b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + max(1, block - size), "right")) - 1)
                held.append((names[a:b], ids[bounds[a] : bounds[b]], bounds[a : b + 1]))
                size += int(bounds[b] - bounds[a])
                a = b
                if size >= block or a < len(names):
                    yield flush()
        if held:
            yield flush()

    ordered = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ordered.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(run, BLOCKS)


def decode(blocks: DataFrame) -> DataFrame:
    """One row per document of the blocks: doc_id, start (ids before it), n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, first, payload in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                block = Block(payload)
                bounds = np.concatenate([[0], np.cumsum(block.counts.astype(np.int64))])
                ids = block.expand(block.symbols).astype("<u4")
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                columns = [np.full(len(crcs), shard), block.doc_ids, bounds[:-1] + first, np.diff(bounds), crcs]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int32(), *[pa.int64()] * 4), strict=True)], ["shard", "doc_id", "start", "n_tokens", "ids_crc32"])

    docs = blocks.select("shard", "first_id", "payload").mapInArrow(run, "shard int, doc_id long, start long, n_tokens long, ids_crc32 long")
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))  # one row per shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return docs.join(F.broadcast(totals), "shard").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")
