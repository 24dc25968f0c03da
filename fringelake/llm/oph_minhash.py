"""Near-duplicates by one-permutation MinHash with optimal densification.

A document's set is its distinct five-word shingles. One hash of each shingle fills ``BINS`` bins with their least
values; an empty bin takes the value of the first filled bin in an order of its own (optimal densification). Bands of
bins are buckets; how many bins a band has follows from the similarity asked for (``band_rows``), so that a link stays
unseen with a chance of ``MISS`` at most. Equal sets are one node from the start, so copies never meet as pairs. In a
bucket, two of its nodes are centres of stars (the least, and the least by a hash that differs from bucket to bucket),
and every node is a candidate with them. Candidates whose set sizes allow the similarity are confirmed on full sets.

What the stars leave out is compared too, where a bucket's other nodes are not all in one component yet: pair by pair in
buckets of at most ``PAIRED`` such nodes, and in larger ones by blocks. A block holds nodes of one class of sizes, or of
two neighbouring ones (others cannot be alike enough), dealt by a hash into parts of bounded size; the sizes of all
intersections in it come from one matrix product, and only a spanning forest of its links leaves it. So no pairs of a
large bucket are ever rows, and no bucket is ever in one task.

Defined cases: texts without words have empty sets and are linked with nothing; a text of fewer than five words has its
whole sequence as its one shingle; rows with equal ids and texts get equal results; rows that share an id but not a text
are separate nodes that share the id's number; a null id is linked with nothing and kept; an empty table gives no rows;
other columns of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, components, dropped, mixed, small_side, steps, stored, text_batches, utf8

SHINGLE, BINS, MISS = 5, 256, 1e-4
SHARE = 85  # per cent of the union
PAIRED = 16  # nodes of a bucket that are compared as pairs
BLOCK_NODES, BLOCK_MEMBERS = 1000, 250_000  # of a part of a block, on average
_rng = np.random.default_rng(11)
PROBE = np.stack([_rng.permutation(BINS) for _ in range(BINS)])
EDGES = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BINS.bit_length() + 1)
_FIRST = 24  # probes tried before all are


def band_rows(share: int) -> int:
    """The most bins a band may have for a pair of this share to miss all bands with a chance of ``MISS`` at most."""
    s = share / 100
    return max([1, *(r for r in range(1, BINS + 1) if (1 - s**r) ** (BINS // r) <= MISS)])


def sets(column: pa.Array) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, ascending."""
    words = Words(*utf8(column), lower=True)
    of, full = words.of, words.grams(SHINGLE)
    out = []
    for a, b in zip(of[:-1].tolist(), of[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(full[a : b - SHINGLE + 1]))
        elif b > a:
            out.append(mixed(np.array([xxhash.xxh3_64_intdigest(words.hashes[a:b].tobytes(), seed=b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(own: np.ndarray) -> np.ndarray:
    """The least value of each bin, empty bins densified. ``own`` is sorted and not empty."""
    at = np.searchsorted(own, EDGES)
    filled = at < np.append(at[1:], len(own))
    values = own[np.minimum(at, len(own) - 1)]
    empty = np.flatnonzero(~filled)
    for probes in (_FIRST, BINS):
        if len(empty):
            order = PROBE[empty, :probes]
            good = filled[order]
            first = order[np.arange(len(empty)), good.argmax(1)]
            values[empty] = values[first]
            empty = empty[~filled[first]]
    return values


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """(documents, bands) keys; bins of a band are spread over the range."""
    bands = BINS // rows
    s = signatures[:, : rows * bands].reshape(len(signatures), rows, bands)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(bands, dtype=np.uint64) + np.uint64(1), (len(s), bands)).copy()
        for r in range(rows):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + s[:, r])
    return key.view(np.int64)


SKETCH = "doc_id long, h long, n_shingles long, digest binary, bands array<long>"


def sketch(docs: DataFrame, share: int = SHARE) -> DataFrame:
    """doc_id, h, n_shingles, digest of the set (null if empty), bands, for ``docs (doc_id, h, text)``."""
    rows = band_rows(share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            own = sets(batch.column(2))
            some = [i for i, s in enumerate(own) if len(s)]
            keys = band_keys(np.stack([signature(own[i]) for i in some]), rows) if some else None
            bands: list = [None] * len(own)
            for k, i in enumerate(some):
                bands[i] = keys[k]
            digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in own]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([len(s) for s in own], pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "h", "n_shingles", "digest", "bands"])

    return docs.mapInArrow(run, SKETCH)


def full_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, members) of ``nodes (node, least, h)``, from the texts of ``docs (doc_id, h, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            yield pa.record_batch([batch.column(0), pa.array([s.view(np.int64) for s in sets(batch.column(1))], pa.list_(pa.int64()))], ["node", "members"])

    one = docs.join(small_side(nodes.select(F.col("least").alias("doc_id"), "h", "node")), ["doc_id", "h"]).dropDuplicates(["node"])
    return stored(one.select("node", "text").mapInArrow(run, "node long, members array<long>"), "sets")


def buckets(nodes: DataFrame) -> DataFrame:
    """(key, node, n, centres) for the buckets of two nodes or more of ``nodes (node, n, bands)``."""
    rows = nodes.select("node", "n", F.explode("bands").alias("key"))
    one = F.struct("node", "n")
    stars = rows.groupBy("key").agg(F.min(one).alias("c1"), F.min(F.struct(F.xxhash64("key", "node").alias("h"), F.col("node").alias("node"), F.col("n").alias("n"))).alias("c2"), F.count("*").alias("m")).where("m > 1")
    return rows.join(stars.select("key", F.array_distinct(F.array("c1", F.struct("c2.node", "c2.n"))).alias("centres")), "key")


def _paired(pairs: DataFrame, share: int) -> DataFrame:
    """Pairs (a, b), a < b, of ``pairs (node, n, c (node, n))`` where the sizes allow the share."""
    pairs = pairs.where("node <> c.node").where(F.least("n", "c.n") * 100 >= F.greatest("n", "c.n") * share)
    return pairs.select(F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b")).distinct()


def unsettled(rest: DataFrame, found: DataFrame) -> DataFrame:
    """``rest (key, node, n)`` of the buckets whose nodes are in several components, with component and m (nodes of the bucket)."""
    placed = rest.select("key", "node", "n").join(small_side(found), "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("m")).where("x < y").select("key", "m")
    return placed.join(small_side(several), "key")


def confirmed(pairs: DataFrame, own: DataFrame, share: int) -> DataFrame:
    """The pairs whose full sets have the share."""
    both = pairs.join(own.select(F.col("node").alias("a"), F.col("members").alias("x")), "a").join(own.select(F.col("node").alias("b"), F.col("members").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y")).cast("long")
    return both.select("a", "b", (common * 100 >= (F.size("x") + F.size("y") - common) * share).alias("linked")).where("linked").select("a", "b")


# --- blocks ------------------------------------------------------------------------------------------------------


def intersections(own: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections of sets without repeated members."""
    m = len(own)
    out = np.zeros((m, m), np.float32)
    member, row = np.concatenate(own), np.repeat(np.arange(m), [len(s) for s in own])
    order = np.argsort(member, kind="stable")
    member, row = member[order], row[order]
    first = np.flatnonzero(np.concatenate([[True], member[1:] != member[:-1]])) if len(member) else np.zeros(0, np.int64)
    often = np.diff(np.append(first, len(member)))
    for d in range(2, 9):  # rare members: their pairs
        at = first[often == d]
        for i in range(d):
            for j in range(i):
                np.add.at(out, (row[at + j], row[at + i]), 1)
    out += out.T
    frequent = np.flatnonzero(often > 8)
    for a in range(0, len(frequent), 4096):  # others: a product of slices
        some = frequent[a : a + 4096]
        have = np.zeros((m, len(some)), np.float32)
        size = often[some]
        ends = np.cumsum(size)
        have[row[np.repeat(first[some] - (ends - size), size) + np.arange(ends[-1])], np.repeat(np.arange(len(some)), size)] = 1
        out += have @ have.T
    return out


def forest(near: np.ndarray, component: np.ndarray) -> list[tuple[int, int]]:
    """Edges of ``near`` that span what it and the components connect; none inside a component."""
    new, out = np.ones(len(near), bool), []
    for root in range(len(near)):
        stack = [root] if new[root] else []
        new[root] = False
        while stack:
            i = stack.pop()
            same = np.flatnonzero(new & (component == component[i]))
            new[same] = False
            stack += same.tolist()
            others = np.flatnonzero(new & near[i])
            new[others] = False
            out += [(i, j) for j in others.tolist()]
            stack += others.tolist()
    return out


def parts(open_: DataFrame, share: int) -> DataFrame:
    """``open_ (key, node, n, component)`` dealt into blocks (key, low, x, y, cross): a node is in each that may hold one like it."""
    step = math.log(100 / share) * 1.0001 if share < 100 else 1e-9
    open_ = open_.withColumn("low", F.floor(F.log("n") / step).cast("int"))
    per = open_.groupBy("key", "low").agg(F.greatest(F.ceil(F.count("*") / BLOCK_NODES), F.ceil(F.sum("n") / BLOCK_MEMBERS)).cast("int").alias("q"))
    per = per.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("low", "q"))).alias("q"))  # one entry per class of sizes
    rows = open_.join(small_side(per), "key").withColumn("part", F.pmod(F.xxhash64("node"), F.col("q")[F.col("low")]).cast("int"))

    def dealt(low, cross: int, x, y):
        n = F.coalesce(F.try_element_at("q", low if cross >= 0 else F.col("low") - 1), F.lit(0))
        return F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), lambda t: F.struct((F.col("low") - (1 if cross < 0 else 0)).alias("low"), x(t).alias("x"), y(t).alias("y"), F.lit(cross != 0).alias("cross")))

    own = F.col("part")
    blocks = F.concat(
        dealt(F.col("low"), 0, lambda t: F.least(own, t), lambda t: F.greatest(own, t)),
        dealt(F.col("low") + 1, 1, lambda t: own, lambda t: t),
        dealt(F.col("low") - 1, -1, lambda t: t, lambda t: own),
    )
    return rows.select("key", "node", "component", F.explode(blocks).alias("block")).select("key", "node", "component", "block.*")


def block_links(open_: DataFrame, own: DataFrame, share: int) -> DataFrame:
    """Links (a, b) that span, with the components, all links within the buckets of ``open_ (key, node, n, component)``."""

    def run(table: pa.Table) -> pa.Table:
        members = [x.values.to_numpy().view(np.uint64) for x in table["members"]]
        size = np.array([len(x) for x in members], np.float64)
        common = intersections(members)
        near = common * 100.0 >= share * (size[:, None] + size[None, :] - common)
        np.fill_diagonal(near, False)
        node = table["node"].to_numpy()
        pairs = [sorted((int(node[i]), int(node[j]))) for i, j in forest(near, table["component"].to_numpy())]
        return pa.table({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})

    rows = parts(open_, share).join(own, "node")
    return rows.groupBy("key", "low", "x", "y", "cross").applyInArrow(run, "a long, b long")


def linked(docs: DataFrame, nodes: DataFrame, share: int = SHARE) -> DataFrame:
    """(node, component) of the nodes that have links; ``nodes (node, least, h, n, bands)``."""
    shared = stored(buckets(nodes.select("node", "n", "bands")), "shared")
    where = nodes.select("node", "least", "h")
    pairs = stored(_paired(shared.select("node", "n", F.explode("centres").alias("c")), share), "pairs")
    own = full_sets(docs, where.join(small_side(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()), "node", "left_semi"))
    links = stored(confirmed(pairs, own, share), "links")
    dropped(own)
    found = stored(components(links), "found")
    # a centre has met all of its bucket and leaves it
    open_ = stored(unsettled(shared.where("not exists(centres, c -> c.node = node)"), found), "open")
    dropped(shared)
    if open_.isEmpty():
        return found
    own = full_sets(docs, where.join(small_side(open_.select("node").distinct()), "node", "left_semi"))
    few, many = open_.where(F.col("m") <= PAIRED), open_.where(F.col("m") > PAIRED)
    other = few.select("key", F.struct("node", "n", "component").alias("c"))
    rest = _paired(few.join(other, "key").where("node < c.node and component <> c.component"), share)
    rest = stored(rest.join(pairs, ["a", "b"], "left_anti"), "pairs")
    more = stored(confirmed(rest, own, share).union(block_links(many.select("key", "node", "n", "component"), own, share)).distinct(), "links")
    dropped(own, open_)
    if more.isEmpty():
        return found
    # components found so far are stars already
    return stored(components(found.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)), "found")


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text", share: int = SHARE) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    text_batches(docs.sparkSession)
    docs = docs.select(F.col(doc).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("text"))
    sketches = stored(sketch(docs, share), "sketch")
    nodes = sketches.where("digest is not null and doc_id is not null").groupBy("digest").agg(F.min(F.struct("doc_id", "h")).alias("one"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    nodes = stored(nodes.select("digest", F.monotonically_increasing_id().alias("node"), F.col("one.doc_id").alias("least"), F.col("one.h").alias("h"), "n", "bands"), "nodes")  # written, so numbers stay
    found = linked(docs, nodes, share)
    placed = nodes.select("digest", "node", "least").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = placed.join(placed.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("digest", "component_id")
    out = sketches.select("doc_id", "n_shingles", "digest").join(placed, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
