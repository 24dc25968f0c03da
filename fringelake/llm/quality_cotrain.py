"""Quality classifier by co-training.

Two views of a document: its text (shares of bytes and of hashed words, shapes of words and lines) and its page's metadata
(language, source, length; address and markup where ``pages`` has the page). A logistic classifier per view learns from
the labelled sample. Over ``ROUNDS`` rounds each view scores all unlabelled documents and hands the other those that it
is surest of, a share of them that grows from round to round; the other takes Newton steps on its labelled rows and on
these. The unlabelled rows never leave the executors: a pass over them returns counts of margins, or the sums that a
Newton step needs. All pseudo-labelled rows together weigh as much as the labelled ones, whatever their number.

A part of the labelled sample that neither view learnt from calibrates each view's margin to log odds, and then combines
the two.

The labelled sample is bounded (``LABELLED`` documents, by a hash of the id); all others take part as unlabelled ones, and
all documents are scored.

Defined cases: null and empty texts have zero shares; a missing page has zero markup features; a page listed twice
counts by its least features; without labels of both kinds every score is the labels' share of 1, or 1; rows with null
ids are scored by what they have and not learnt from; repeated rows are scored alike; very long texts are read whole; an
empty table gives no rows; other columns of documents are passed on, whatever their names, but for those named
text_margin, meta_margin, score or predicted, which are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import STEP_BYTES, Words, dropped, free_name, stored, text_batches, utf8
from .toxicity_fm import held_out

LABELLED, ROUNDS, STEPS, GROWTH, SURE = 8000, 4, 2, 0.08, 2.0
BINS, REACH = 400, 20.0  # of a margin's counts
BUCKETS = 32  # rows of sums that meet in one task at most
SLICE, BYTES = 1024, 1 << 19  # rows that the sums of a Newton step take at a time, and bytes that are counted at a time
LANGS, SOURCES, ENDINGS, WORDS = 8, 32, 8, 64


def text_features(column: pa.Array) -> np.ndarray:
    """(rows, features): shares of the 128 ASCII bytes and of the others, shapes of words and lines, shares of hashed words."""
    data, bounds = utf8(column)
    n, size = len(column), np.diff(bounds)
    row, shares = np.repeat(np.arange(n, dtype=np.int32), size), np.zeros(n * 129, np.int64)
    for at in range(0, len(data), BYTES):
        shares += np.bincount(row[at : at + BYTES].astype(np.int64) * 129 + np.minimum(data[at : at + BYTES], 128), minlength=n * 129)
    shares = shares.reshape(n, 129) / np.maximum(1, size)[:, None]
    del row
    words = Words(data, bounds)
    count = np.diff(words.of)
    of = np.repeat(np.arange(n), count)
    length = words.ends - words.starts
    # distinct words and neighbours, and the commonest word's share
    key = np.sort(words.hashes >> np.uint64(20) | (of.astype(np.uint64) << np.uint64(44)))
    new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
    owner = (key[new] >> np.uint64(44)).astype(np.int64)
    times = np.diff(np.append(np.flatnonzero(new), len(key)))
    most = np.zeros(n)
    np.maximum.at(most, owner, times)
    again = np.bincount(of[1:], (words.hashes[1:] == words.hashes[:-1]) & (of[1:] == of[:-1]), n) if len(of) > 1 else np.zeros(n)
    per = np.maximum(1, count)
    mean = np.bincount(of, length, n) / per
    spread = np.sqrt(np.maximum(0, np.bincount(of, length.astype(float) ** 2, n) / per - mean**2))
    shape = np.stack([np.log1p(size), np.log1p(count), mean, spread, np.bincount(owner, minlength=n) / per, most / per, again / per, np.bincount(of, length < 3, n) / per], 1)
    upper, lower, alpha = shares[:, 65:91].sum(1), shares[:, 97:123].sum(1), shares[:, 48:58].sum(1)
    marks = shares[:, 33:48].sum(1) + shares[:, 58:65].sum(1) + shares[:, 91:97].sum(1) + shares[:, 123:127].sum(1)
    hashed = np.bincount(of * WORDS + (words.hashes >> np.uint64(40)).astype(np.int64) % WORDS, minlength=n * WORDS).reshape(n, WORDS) / per[:, None]
    return np.concatenate([np.sqrt(shares), shape, np.stack([upper, lower, alpha, marks, upper / (upper + lower + 1e-3)], 1), np.sqrt(hashed)], 1)


TEXT = 129 + 8 + 5 + WORDS


def page_features(pages: DataFrame) -> DataFrame:
    """(page_id, page): an array of doubles per page."""
    url, html = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))

    def tags(tag: str) -> Column:
        return F.log1p((F.length(html) - F.length(F.replace(html, F.lit(f"<{tag}"), F.lit("")))) / (len(tag) + 1))

    ending = F.pmod(F.xxhash64(F.regexp_extract(url, r"^[a-z]+://[^/]*?([^./]+)(?:/|$)", 1)), F.lit(ENDINGS))
    plain = [F.lit(1.0), F.log1p(F.length(url)), F.size(F.split(url, "/")), F.instr(url, "?") > 0, F.startswith(url, F.lit("https")), F.log1p(F.length(html)), tags("a "), tags("p"), tags("li"), tags("script"), tags("div"), tags("h")]
    page = F.array(*[x.cast("double") for x in plain], *[(ending == i).cast("double") for i in range(ENDINGS)])
    return pages.select("page_id", page.alias("page")).where("page_id is not null").groupBy("page_id").agg(F.min("page").alias("page"))


PAGE = 12 + ENDINGS
META = LANGS + SOURCES + 1 + PAGE


def meta_features(lang: Column, source: Column, n_chars: Column, page: Column) -> Column:
    def one_of(c: Column, n: int) -> list[Column]:
        slot = F.pmod(F.xxhash64(F.coalesce(c.cast("string"), F.lit(""))), F.lit(n))
        return [(slot == i).cast("double") for i in range(n)]

    return F.concat(F.array(*one_of(lang, LANGS), *one_of(source, SOURCES), F.log1p(F.coalesce(n_chars, F.lit(0)).cast("double"))), F.coalesce(page, F.array_repeat(F.lit(0.0), PAGE)))


class Logistic:
    """Ridge logistic regression on standardised features, by Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> None:
        self.mean, self.scale, self.ridge = x.mean(0), x.std(0) + 1e-6, ridge
        self.weights = np.zeros(x.shape[1] + 1)
        for _ in range(15):
            if self.step(*self.sums(x, y)) < 1e-5:
                break

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.c_[np.clip((x - self.mean) / self.scale, -8, 8), np.ones(len(x))]

    def sums(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the rows add to the second and the first derivatives."""
        d = len(self.weights)
        second, first = np.zeros((d, d)), np.zeros(d)
        for at in range(0, len(x), SLICE):
            z = self.standard(x[at : at + SLICE])
            p = 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))
            second += (z * (p * (1 - p) + 1e-6)[:, None]).T @ z
            first += z.T @ (y[at : at + SLICE] - p)
        return second, first

    def step(self, second: np.ndarray, first: np.ndarray) -> float:
        penalty = np.full(len(self.weights), self.ridge)
        penalty[-1] = 1e-6
        by = np.linalg.solve(second + np.diag(penalty), first - penalty * self.weights)
        self.weights = self.weights + by
        return float(np.abs(by).max())

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.standard(x) @ self.weights


class Model:
    """Two views' classifiers, their calibrations, and the combination of the calibrated log odds."""

    def __init__(self, views: list[Logistic] | None, rate: float) -> None:
        self.views, self.rate = views, rate
        self.scales: list[Logistic] = []
        self.joint: Logistic | None = None

    def calibrate(self, views: tuple[np.ndarray, np.ndarray], y: np.ndarray) -> None:
        self.scales = [Logistic(v.margin(x)[:, None], y, 0.1) for v, x in zip(self.views, views, strict=True)]
        self.joint = Logistic(np.stack([self.odds(k, x) for k, x in enumerate(views)], 1), y, 0.1)

    def calibrated(self, k: int, margin: np.ndarray) -> np.ndarray:
        return self.scales[k].margin(margin[:, None])

    def odds(self, k: int, x: np.ndarray) -> np.ndarray:
        """A view's calibrated log odds."""
        return self.calibrated(k, self.views[k].margin(x))

    def combine(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        """Scores from the two views' margins."""
        if self.views is None:
            return np.full(len(text), self.rate)
        both = np.stack([self.calibrated(0, text), self.calibrated(1, meta)], 1)
        return 1 / (1 + np.exp(-np.clip(self.joint.margin(both), -30, 30)))


Pass = Callable[[Callable[[np.ndarray, np.ndarray], np.ndarray]], np.ndarray]


def co_train(text: np.ndarray, meta: np.ndarray, label: np.ndarray, over: Pass, rounds: int = ROUNDS, growth: float = GROWTH) -> Model:
    """Learns from labelled rows and, by ``over``, from all unlabelled ones: ``over(f)`` adds up ``f(text, meta)`` of their batches."""
    rate = float(label.mean()) if len(label) else 1.0
    aside = np.arange(len(label)) % 4 == 0
    if len(set(label[aside])) < 2 or len(set(label[~aside])) < 2:
        return Model(None, rate)
    y = label.astype(float)
    views = (text, meta)
    model = Model([Logistic(v[~aside], y[~aside]) for v in views], rate)
    model.calibrate((text[aside], meta[aside]), y[aside])
    edges = np.linspace(-REACH, REACH, BINS + 1)
    for r in range(1, rounds + 1):

        def counts(t: np.ndarray, m: np.ndarray) -> np.ndarray:
            return np.stack([np.histogram(np.clip(model.odds(k, x), -REACH, REACH), edges)[0] for k, x in enumerate((t, m))]).astype(float)

        seen = over(counts)
        if not np.any(seen):
            break
        # each view's surest shares of either kind, and only what it is sure of
        sure = []
        for own in seen:
            below, above = np.cumsum(own), np.cumsum(own[::-1])[::-1]
            low = edges[1:][below <= growth * r * (1 - rate) * own.sum()]
            high = edges[:-1][above <= growth * r * rate * own.sum()]
            sure.append((min(-SURE, low[-1]) if len(low) else -np.inf, max(SURE, high[0]) if len(high) else np.inf))
        known = Model(model.views, rate)  # whose judgement holds in this round
        known.scales = model.scales
        learners = [Logistic.__new__(Logistic) for _ in views]
        for new, old in zip(learners, model.views, strict=True):
            new.__dict__.update(old.__dict__)
        for _ in range(STEPS):

            def sums(t: np.ndarray, m: np.ndarray) -> np.ndarray:
                out = []
                for k, (own, other) in enumerate(((t, m), (m, t))):
                    odds = known.odds(1 - k, other)
                    zero, one = odds <= sure[1 - k][0], odds >= sure[1 - k][1]
                    taken = zero | one
                    second, first = learners[k].sums(own[taken], one[taken].astype(float))
                    out += [second.ravel(), first, [taken.sum()]]
                return np.concatenate(out)

            found = over(sums)
            for k, v in enumerate(views):
                d = v.shape[1] + 1
                (second, first, n), found = np.split(found[: d * d + d + 1], [d * d, d * d + d]), found[d * d + d + 1 :]
                own_second, own_first = learners[k].sums(v[~aside], y[~aside])
                weight = min(1.0, (~aside).sum() / max(1.0, n[0]))
                learners[k].step(own_second + weight * second.reshape(d, d), own_first + weight * first)
        model = Model(learners, rate)
        model.calibrate((text[aside], meta[aside]), y[aside])
    return model


def passes(pool: DataFrame) -> Pass:
    """Sums over all rows of ``pool (x, m)``, added up within tasks, in BUCKETS groups of tasks and in one task: one row reaches the driver.

    A row has half a megabyte, which the driver's JVM holds several times over as it is read, decoded and handed to Python.
    """

    def over(f: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                if batch.num_rows:
                    part = f(matrix(batch.column(0), TEXT), matrix(batch.column(1), META))
                    total = part if total is None else total + part
            if total is not None:
                yield pa.record_batch([pa.array([TaskContext.get().partitionId() % BUCKETS], pa.int32()), pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary()), pa.array([list(total.shape)], pa.list_(pa.int32()))], ["bucket", "at", "total", "shape"])

        def added(table: pa.Table) -> pa.Table:
            table = table.sort_by("at")  # not as the shuffle brings them
            total = sum(np.frombuffer(x) for x in table["total"].to_pylist())
            return pa.table({"at": table["at"][:1], "total": pa.array([total.tobytes()], pa.binary()), "shape": table["shape"][:1]})

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            some = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
            if some:
                yield from added(pa.concat_tables(some)).to_batches()

        sums = "at int, total binary, shape array<int>"
        by_bucket = pool.mapInArrow(run, f"bucket int, {sums}").groupBy("bucket").applyInArrow(added, sums)
        rows = by_bucket.repartition(1).mapInArrow(whole, sums).collect()  # one task for at most BUCKETS rows
        return np.frombuffer(rows[0].total).reshape(rows[0].shape) if rows else np.zeros(0)

    return over


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, width).astype(float)


def fit(docs: DataFrame, labels: DataFrame, pages: DataFrame, labelled: int = LABELLED, doc: str = "doc_id") -> Model:
    """Learns from rows that are not held out (crc32 of the id, modulo 5)."""
    text_batches(docs.sparkSession)
    known = labels.select(F.col(doc).alias("doc_id"), F.col("quality").cast("int").alias("label")).where("label is not null and doc_id is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    base = docs.select(F.col(doc).alias("doc_id"), "text", "lang", "source", "n_chars").where("doc_id is not null").where(~held_out(F.col("doc_id")))
    some = known.join(base.select("doc_id").distinct(), "doc_id").orderBy(F.xxhash64("doc_id"), F.col("doc_id")).limit(labelled)  # a bounded sample
    rows = base.withColumns({"x": _features("text"), "h": F.xxhash64("text")}).drop("text").join(F.broadcast(some), "doc_id", "left")
    rows = rows.join(page_features(pages), F.col("doc_id") == F.col("page_id"), "left")
    meta = _packed(meta_features(F.col("lang"), F.col("source"), F.col("n_chars"), F.col("page")))
    table = stored(rows.select("doc_id", "h", "label", "x", meta.alias("m")), "views")
    one = table.where("label is not null").groupBy("doc_id").agg(F.min(F.struct("h", "label", "x", "m")).alias("one")).select("doc_id", "one.*")
    sample = one.toArrow().sort_by("doc_id")  # at most `labelled` rows of a fixed width
    if not sample.num_rows:
        return Model(None, 1.0)
    text, meta, label = matrix(sample["x"], TEXT), matrix(sample["m"], META), sample["label"].to_numpy()
    del sample
    model = co_train(text, meta, label, passes(table.where("label is null").select("x", "m")))
    dropped(table)
    return model


@F.pandas_udf(T.BinaryType())
def _features(texts: pd.Series) -> pd.Series:
    column, out, at = pa.array(texts, pa.large_string(), from_pandas=True), [], 0
    bounds = utf8(column)[1]
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + STEP_BYTES, "right")) - 1)
        out += [x.tobytes() for x in text_features(column.slice(at, to - at)).astype(np.float32)]
        at = to
    return pd.Series(out, dtype=object)


@F.pandas_udf(T.BinaryType())
def _packed(rows: pd.Series) -> pd.Series:
    return pd.Series([np.asarray(x, np.float32).tobytes() for x in rows], dtype=object)


def scored(docs: DataFrame, model: Model, pages: DataFrame, keep_text: bool = False, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` (without the text, unless kept) with text_margin, meta_margin, score (quality, 0 to 1), predicted."""
    text_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def by_text(texts: pd.Series) -> pd.Series:
        if model.views is None:
            return pd.Series(np.zeros(len(texts)))
        column, out, at = pa.array(texts, pa.large_string(), from_pandas=True), [], 0
        bounds = utf8(column)[1]
        while at < len(column):
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + STEP_BYTES, "right")) - 1)
            out.append(model.views[0].margin(text_features(column.slice(at, to - at))))
            at = to
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    @F.pandas_udf("meta_margin double, score double")
    def by_both(t: pd.Series, m: pd.Series) -> pd.DataFrame:
        meta = model.views[1].margin(np.stack(m.to_numpy())) if model.views is not None and len(m) else np.zeros(len(m))
        return pd.DataFrame({"meta_margin": meta, "score": model.combine(t.to_numpy(float), meta)})

    rows = docs.drop("meta_margin", "score", "predicted").withColumn("text_margin", by_text(F.col(text)))
    rows = rows if keep_text else rows.drop(text)
    page_id, own_page, both = (free_name(docs, x) for x in ("_page_id", "_page", "_both"))
    page = page_features(pages).select(F.col("page_id").alias(page_id), F.col("page").alias(own_page))
    rows = rows.join(page, F.col(doc) == F.col(page_id), "left")
    rows = rows.withColumn(both, by_both(F.col("text_margin"), meta_features(F.col("lang"), F.col("source"), F.col("n_chars"), F.col(own_page))))
    rows = rows.withColumns({"meta_margin": F.col(f"{both}.meta_margin"), "score": F.col(f"{both}.score")}).drop(both, own_page, page_id)
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
