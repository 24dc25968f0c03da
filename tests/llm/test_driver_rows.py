"""What the corpus operators send to the driver does not grow with the number of tasks."""

import tracemalloc

import numpy as np
from pyspark.sql.classic.dataframe import DataFrame

from fringelake.llm import quality_cotrain as Q
from fringelake.llm.common import Words


def test_one_row_of_sums_reaches_the_driver(spark, monkeypatch):
    rng = np.random.default_rng(3)
    text, meta = rng.normal(size=(400, Q.TEXT)).astype(np.float32), rng.normal(size=(400, Q.META)).astype(np.float32)
    pool = spark.createDataFrame([(bytearray(t.tobytes()), bytearray(m.tobytes())) for t, m in zip(text, meta, strict=True)], "x binary, m binary").repartition(Q.BUCKETS + 8)
    sent, collect = [], DataFrame.collect

    def counted(self):
        sent.append(collect(self))
        return sent[-1]

    monkeypatch.setattr(DataFrame, "collect", counted)
    over = Q.passes(pool)
    got = over(lambda t, m: np.stack([t.sum(0)[:5], m.sum(0)[:5], np.full(5, len(t))]).astype(float))
    np.testing.assert_allclose(got, [text.sum(0, dtype=float)[:5], meta.sum(0, dtype=float)[:5], [400.0] * 5], atol=1e-9)
    assert [len(rows) for rows in sent] == [1]
    assert not len(Q.passes(pool.limit(0))(lambda t, m: t.sum(0)))


def test_newton_sums_by_slices():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(2 * Q.SLICE + 100, 6))
    y = (x[:, 0] + rng.normal(size=len(x)) > 0).astype(float)
    m = Q.Logistic(x, y)
    z = m.standard(x)
    p = 1 / (1 + np.exp(-np.clip(z @ m.weights, -30, 30)))
    second, first = m.sums(x, y)
    np.testing.assert_allclose(second, (z * (p * (1 - p) + 1e-6)[:, None]).T @ z)
    np.testing.assert_allclose(first, z.T @ (y - p), atol=1e-9)
    assert not np.any(m.sums(x[:0], y[:0])[0])


def test_words_of_a_long_text_take_few_arrays_of_its_length():
    rng = np.random.default_rng(5)
    data = rng.choice(np.frombuffer(b" ab\n", np.uint8), 1 << 21, p=[0.1, 0.5, 0.35, 0.05])
    data[700_000:1_000_000] = 97  # a word longer than a slice
    tracemalloc.start()
    words = Words(data, np.array([0, len(data)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 28 * len(data)  # 22 times; 32 with every array whole
    at = int(np.searchsorted(words.starts, 690_000))
    for i in [0, *range(at, at + 3000), len(words.starts) - 1]:
        one = data[words.starts[i] : words.ends[i]]
        assert Words(one, np.array([0, len(one)])).hashes.tolist() == [words.hashes[i]]
