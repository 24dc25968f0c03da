"""Toxicity by a factorization machine over hashed terms.

Terms are a text's distinct words (A-Z lower-cased) and word beginnings of six bytes, hashed into ``DIMS`` features. The
machine has a weight per feature and ``RANK`` latent factors whose inner products weigh pairs, so two terms together can
say what neither says alone; pair sums cost one pass per factor. It is trained by Adagrad on the logistic loss over at
most ``SAMPLE`` labelled documents with at most ``SAMPLE_BYTES`` of features, taken by a hash of their ids; the model is a
fixed number of floats.

Defined cases: null, empty and wordless texts get the bias's score; labels that are null are not learnt from; a document
labelled twice counts by its highest label; of several texts under one id, one is learnt from (the least hash); without
any label the score is 0.5 throughout; very long texts are scored whole; an empty table gives no rows; other columns of
the inputs are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, dropped, steps, stored, text_batches, utf8

BITS, RANK, SAMPLE, SAMPLE_BYTES = 18, 6, 20_000, 64 << 20
DIMS = 1 << BITS
BEGIN = 6
EPOCHS, BATCH, RATE, DECAY, LEAST_DOCS = 20, 256, 0.15, 1e-3, 4
LEAST_Z, PAIR_Z, FREQUENT, PAIR_ROWS, PAIR_BLOCK = 4.0, 6.0, 0.05, 1000, 1000


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs of a column of texts, as two arrays."""
    words = Words(*utf8(column), lower=True, plain=True)
    row = np.repeat(np.arange(len(column)), np.diff(words.of))
    long_ = words.ends - words.starts > BEGIN
    begins = words.hashed(np.flatnonzero(long_), np.full(int(long_.sum()), BEGIN))
    shift = np.uint64(64 - BITS)
    both = np.concatenate([row << BITS | (words.hashes >> shift).astype(np.int64), row[long_] << BITS | ((begins ^ np.uint64(0x5BD1E995)) >> shift).astype(np.int64)])
    both = np.unique(both)
    return both >> BITS, both & (DIMS - 1)


class Machine:
    def __init__(self, bias: float, weights: np.ndarray, factors: np.ndarray, used: np.ndarray) -> None:
        self.bias, self.weights, self.factors, self.used = bias, weights, factors, used

    def raw(self, row: np.ndarray, feature: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Margins of n rows, each row's scale, and the factor sums; ``feature`` holds used features only."""
        scale = 1 / np.sqrt(np.maximum(1, np.bincount(row, minlength=n)))
        linear = np.bincount(row, self.weights[feature], n)
        sums, pairs = np.empty((n, self.factors.shape[1])), np.zeros(n)
        for f in range(self.factors.shape[1]):
            v = self.factors[feature, f]
            sums[:, f] = np.bincount(row, v, n)
            pairs += sums[:, f] ** 2 - np.bincount(row, v * v, n)
        return self.bias + scale * linear + 0.5 * scale**2 * pairs, scale, sums

    def score(self, row: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        used = self.used[feature]
        return 1 / (1 + np.exp(-np.clip(self.raw(row[used], feature[used], n)[0], -30, 30)))


def differs(pos: np.ndarray, both: np.ndarray, ones: float, every: int) -> np.ndarray:
    """By how many standard errors a term's share among rows of label 1 differs from that among the others."""
    share = both / every
    spread = share * (1 - share) * (1 / max(1, ones) + 1 / max(1, every - ones))
    return np.abs(pos / max(1, ones) - (both - pos) / max(1, every - ones)) / np.sqrt(np.maximum(1e-12, spread))


def chosen(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """The features to learn: those whose share among rows of either label differs beyond chance, and frequent ones that
    are in a pair whose share does. Others would only dilute them."""
    of = np.repeat(labels, [len(r) for r in rows])
    feature = np.concatenate(rows).astype(np.int64)
    ones, every = labels.sum(), len(labels)
    pos, both = np.bincount(feature, of, DIMS), np.bincount(feature, minlength=DIMS)
    out = (both >= LEAST_DOCS) & (differs(pos, both, ones, every) >= LEAST_Z)
    often = np.flatnonzero(~out & (both >= FREQUENT * every))  # at most the mean row's terms / FREQUENT
    place = np.full(DIMS, -1)
    place[often] = np.arange(len(often))
    tells = np.zeros(len(often), bool)
    for b in range(0, len(often), PAIR_BLOCK):  # pairs of a block's terms with all: memory goes with the block's size
        pos2, both2 = np.zeros((2, min(PAIR_BLOCK, len(often) - b), len(often)), np.float32)
        for at in range(0, every, PAIR_ROWS):
            some, toxic = rows[at : at + PAIR_ROWS], labels[at : at + PAIR_ROWS] > 0
            have = np.zeros((len(some), len(often)), np.float32)
            for i, r in enumerate(some):
                own = place[r]
                have[i, own[own >= 0]] = 1
            both2 += have[:, b : b + PAIR_BLOCK].T @ have
            pos2 += have[toxic, b : b + PAIR_BLOCK].T @ have[toxic]
        tells[b : b + PAIR_BLOCK] = ((both2 >= LEAST_DOCS) & (differs(pos2, both2, ones, every) >= PAIR_Z)).any(axis=1)
    out[often[tells]] = True
    return out


def train(rows: list[np.ndarray], labels: np.ndarray, seed: int = 3) -> Machine:
    rng = np.random.default_rng(seed)
    machine = Machine(0.0, np.zeros(DIMS), np.zeros((DIMS, RANK)), np.zeros(DIMS, bool))
    if not len(labels):
        return machine
    rate = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    machine.bias = float(np.log(rate / (1 - rate)))
    machine.used = seen = chosen(rows, labels)
    rows = [r[seen[r]] for r in rows]
    machine.factors[seen] = rng.normal(0, 0.05, (int(seen.sum()), RANK))
    grown_w, grown_v, grown_b = np.full(DIMS, 1e-6), np.full((DIMS, RANK), 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            feature = np.concatenate([rows[i] for i in pick]).astype(np.int64)
            row = np.repeat(np.arange(len(pick)), [len(rows[i]) for i in pick])
            margin, scale, sums = machine.raw(row, feature, len(pick))
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[pick]) * len(pick) ** -0.5
            used, at_used = np.unique(feature, return_inverse=True)
            e1, e2 = (error * scale)[row], (error * scale**2)[row]
            g = np.bincount(at_used, e1) + DECAY * machine.weights[used]
            grown_w[used] += g * g
            machine.weights[used] -= RATE * g / np.sqrt(grown_w[used])
            for f in range(RANK):
                v = machine.factors[used, f]
                g = np.bincount(at_used, e2 * sums[row, f]) - np.bincount(at_used, e2) * v + DECAY * v
                grown_v[used, f] += g * g
                machine.factors[used, f] -= RATE * 0.5 * g / np.sqrt(grown_v[used, f])
            g = error.sum()
            grown_b += g * g
            machine.bias -= RATE * g / grown_b**0.5
    return machine


def held_out(doc: Column) -> Column:
    return F.crc32(F.coalesce(doc.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def sample_rows(docs: DataFrame, labels: DataFrame, label: str, sample: int, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(h, label, text) of at most ``sample`` labelled documents that are not held out, one row an id; h is a hash of the id."""
    some = labels.select(F.col(doc).alias("doc_id"), F.col(label).cast("int").alias("label")).where("label is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    some = some.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select(F.col(doc).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(some), "doc_id")
    one = rows.groupBy("doc_id").agg(F.max("label").alias("label"), F.min(F.struct(F.xxhash64("text").alias("t"), "text")).alias("one"))
    return one.select(F.xxhash64("doc_id").alias("h"), "label", F.col("one.text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE, doc: str = "doc_id", text: str = "text", sample_bytes: int = SAMPLE_BYTES) -> Machine:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            row, feature = terms(batch.column(2))
            cut = np.searchsorted(row, np.arange(batch.num_rows + 1))
            data = [feature[a:b].astype("<i4").tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(data, pa.binary())], ["h", "label", "features"])

    text_batches(docs.sparkSession)
    rows = stored(sample_rows(docs, labels, label, sample, doc, text).mapInArrow(run, "h long, label int, features binary"), "features")
    size = rows.select("h", F.octet_length("features").alias("n")).orderBy("h").toPandas()  # at most `sample` rows of two numbers
    fits = size.h[size.n.cumsum() <= sample_bytes]
    kept = sorted(rows.where(F.col("h") <= int(fits.max())).collect(), key=lambda r: (r.h, r.features)) if len(fits) else []
    dropped(rows)
    return train([np.frombuffer(r.features, "<i4") for r in kept], np.array([r.label for r in kept], float))


def score(docs: DataFrame, machine: Machine, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score, predicted for every row; only the text is scored."""
    text_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast((machine.bias, machine.weights.astype(np.float32), machine.factors.astype(np.float32), machine.used))  # (1 + RANK) * DIMS floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Machine(*sent.value)
        for batch in steps(batches):
            s = model.score(*terms(batch.column(1)), batch.num_rows)
            yield pa.record_batch([batch.column(0), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, score double, predicted int")
