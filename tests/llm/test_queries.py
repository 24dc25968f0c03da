"""The registered corpus queries on the smallest tables: against their SQL, or against plain versions where SQL has none."""

import glob
import itertools
import os
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from fringelake.llm import decontaminate_winnow, line_chunks, merkle, oph_minhash, pack_slack, quality_cotrain, queries, repair_tokens, toxicity_fm
from fringelake.llm.common import Words, utf8
from fringelake.llm.tokens import tokens_of, vocabulary

SF = "/root/testdata/sf0.001"


def rows(df):
    cols = sorted(df.columns)
    return sorted(tuple("None" if pd.isna(x) else repr(round(float(x), 6) + 0.0) if isinstance(x, (float, int, np.number)) and not isinstance(x, (bool, np.bool_)) else str(x) for x in r) for r in df[cols].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' order by doc_id").fetchall())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_against_its_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    want, got = con.execute(queries.oracle_sql()[name]).df(), queries.queries()[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def ids_of(text):
    return np.array([*tokens_of(vocabulary()).tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def test_token_query(spark, texts):
    at, want = 0, set()
    for k, t in texts.items():
        ids = ids_of(t)
        want.add((k, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert {tuple(r) for r in queries.op3_repair_tokens(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()} == want


def test_packing_query(spark, texts):
    got = queries.op10_min_slack_packing(spark, SF).collect()
    ids, cover, bins = {k: ids_of(t) for k, t in texts.items()}, Counter(), defaultdict(list)
    for r in got:
        x = ids[r.doc_id]
        assert r.doc_tokens == len(x) and r.ids_crc32 == zlib.crc32(x[r.start : r.start + r.length].tobytes())
        cover.update((r.doc_id, i) for i in range(r.start, r.start + r.length))
        bins[r.sequence_id].append((r.offset, r.length))
    assert len(cover) == sum(map(len, ids.values())) and set(cover.values()) == {1}
    for own in bins.values():
        own.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and own[0][0] == 0 and sum(own[-1]) <= 2048
    assert len(bins) <= sum(map(len, ids.values())) / 2048 * 1.02 + 8


def test_fill_is_the_best_multiset():
    rng = np.random.default_rng(3)
    for _ in range(200):
        counts = {int(k): int(rng.integers(1, 4)) for k in rng.integers(1, 40, 5)}
        room = int(rng.integers(1, 90))
        sums = {sum(k * n for k, n in zip(counts, ns)) for ns in itertools.product(*[range(v + 1) for v in counts.values()])}
        used = pack_slack.fill(room, counts)
        assert all(used[k] <= counts[k] for k in used) and sum(k * n for k, n in used.items()) == max(s for s in sums if s <= room)


def test_line_query(spark, texts):
    """Chunks by a plain reading of the rule: an end after two lines whose hashes say so, or after sixteen."""

    def chunked(t):
        out, own = [], []
        for line in t.split("\n"):
            own.append(line)
            h = [xxhash.xxh3_64_intdigest(x.encode()) for x in own[-2:]]
            if len(own) == 16 or len(own) > 1 and (h[0] * 31 + h[1] >> 7) % 4 == 0:
                out.append(own)
                own = []
        return out + [own] if own else out

    seen, want = set(), {}
    for k, t in texts.items():
        kept, n, parts = [], 0, [] if t is None else chunked(t)
        for c in parts:
            n += len(c)
            if len(c) < 2 or tuple(c) not in seen:
                kept += c
            if len(c) > 1:
                seen.add(tuple(c))
        want[k] = (n, len(parts), n - len(kept), __import__("hashlib").sha256("\n".join(kept).encode()).hexdigest())
    assert {r[0]: tuple(r)[1:] for r in queries.op5_line_chunks(spark, SF).collect()} == want


def test_clashing_names_and_long_texts(spark):
    long_ = "\n".join(f"line {i} of a very long text, with words" for i in range(20_000))
    d = spark.createDataFrame([(1, long_, "en", "s", 1, "a", "b"), (2, long_, None, None, None, "c", None)], "doc_id long, text string, lang string, source string, n_chars long, _k string, _cut string")
    got = {r.doc_id: r for r in line_chunks.line_dedup(d).collect()}
    assert got[1]._k == "a" and got[2]._k == "c" and got[1]._cut.n_removed == 0 and got[2]._cut.n_removed > 19_000
    pages = spark.createDataFrame([(1, "https://a.org", "<p>")], "page_id long, url string, html string")
    q = quality_cotrain.scored(d.withColumn("score", F.lit("x")).withColumn("_page", F.lit("y")), quality_cotrain.Model(None, 0.5), pages).collect()
    assert [r.score for r in q] == [0.5, 0.5] and [r._page for r in q] == ["y", "y"]
    bench = spark.createDataFrame([(7, long_[:2000])], "item_id long, text string")
    hit = decontaminate_winnow.decontaminate(d.withColumn("item_id", F.lit(1)).withColumn("print", F.lit(1)), bench).collect()
    assert len(hit) == 2 and all(r.n_hit > 300 and r.n_items == 1 and not r.contaminated for r in hit)
    assert {r.component_id for r in oph_minhash.near_duplicates(d.withColumn("node", F.lit(1))).collect()} == {1}
    assert {r.near_next for r in merkle.fingerprints(d.withColumn("k", F.lit(1))).collect()} == {1.0}
    blocks = repair_tokens.encode(d.withColumn("shard", F.lit(9)), vocabulary())
    assert sum(r.n_tokens for r in repair_tokens.decode(blocks).collect()) == 2 * len(ids_of(long_))


def test_words_that_polynomials_confuse():
    """A Thue-Morse word and its complement have one sum under any polynomial modulo a power of two."""
    for size in (1024, 2048, 4096):
        word = "".join("ab"[bin(i).count("1") % 2] for i in range(size))
        w = Words(*utf8(pa.array([word, word.translate(str.maketrans("ab", "ba"))])))
        assert len(w.hashes) == 2 and w.hashes[0] != w.hashes[1]


def test_near_rows_that_share_an_id(spark):
    a, b = ([f"{c}{i}" for i in range(300)] for c in "ab")
    rows_ = [(3, " ".join(a)), (3, " ".join(b)), (4, " ".join([*a, "x"])), (8, " ".join([*b, "x"])), (9, "z " * 3)]
    got = {r.doc_id: r.component_id for r in oph_minhash.near_duplicates(spark.createDataFrame(rows_, "doc_id long, text string")).collect()}
    assert got == {3: 3, 4: 3, 8: 3, 9: 9}


def test_near_recall_on_random_pairs(spark):
    """Every pair just at the similarity asked for is found, at many lengths."""
    rng, rows_, want = np.random.default_rng(8), [], {}
    for k in range(300):
        n = int(rng.choice([30, 60, 120, 400]))
        words = [f"t{k}w{i}" for i in range(n)]
        shared = n - 4 - int((n - 4) * 0.15)  # a prefix in common: this many shingles
        other = words[: shared + 4] + [f"o{k}w{i}" for i in range(max(0, int((n - 4) * 0.15 * 0.15)))]
        rows_ += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
        x, y = ({tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (words, other))
        want[k] = 100 * len(x & y) >= 85 * len(x | y)
    got = {r.doc_id: r.component_id for r in oph_minhash.near_duplicates(spark.createDataFrame(rows_, "doc_id long, text string")).collect()}
    linked = [k for k in want if want[k]]
    assert len(linked) > 50 and sum(got[2 * k + 1] == 2 * k for k in linked) >= 0.99 * len(linked) and all(got[2 * k + 1] == 2 * k + 1 for k in want if not want[k])


def test_intersections_and_forest():
    rng = np.random.default_rng(4)
    own = [np.unique(rng.integers(0, 60, rng.integers(1, 40))).astype(np.uint64) for _ in range(50)]
    got = oph_minhash.intersections(own)
    for i, j in itertools.combinations(range(50), 2):
        assert got[i, j] == got[j, i] == len(np.intersect1d(own[i], own[j]))
    near = np.zeros((6, 6), bool)
    for i, j in ((0, 1), (1, 2), (0, 2), (3, 4)):
        near[i, j] = near[j, i] = True
    assert len(oph_minhash.forest(near, np.arange(6))) == 3 and len(oph_minhash.forest(near, np.array([0, 0, 0, 1, 2, 3]))) == 1


def test_machine_against_the_sum_over_pairs():
    rng = np.random.default_rng(6)
    m = toxicity_fm.Machine(0.3, rng.normal(size=50), rng.normal(size=(50, 4)), np.ones(50, bool))
    for _ in range(20):
        f = np.sort(rng.choice(50, 7, replace=False))
        plain = 0.3 + m.weights[f].sum() / 7**0.5 + sum(m.factors[a] @ m.factors[b] for a, b in itertools.combinations(f, 2)) / 7
        assert m.raw(np.zeros(7, int), f, 1)[0][0] == pytest.approx(plain)


def test_toxicity_sample_holds_its_caps(spark):
    d = spark.createDataFrame([(1, f"text {i}") for i in range(3000)] + [(i, "words here") for i in range(2, 40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id long, toxic int")
    assert toxicity_fm.sample_rows(d, labels, "toxic", 2).count() == 2
    assert toxicity_fm.fit(d, labels, sample_bytes=1).bias == 0.0


def test_co_training_uses_all_unlabelled_rows():
    """Each view alone has few labels; pseudo-labels of the other view's sure rows teach it a direction that they do not show."""
    rng = np.random.default_rng(9)
    y = rng.integers(0, 2, 4000)
    text = np.c_[y + rng.normal(0, 0.3, 4000), y * 2 + rng.normal(0, 1, 4000)]
    meta = np.c_[y + rng.normal(0, 0.3, 4000), rng.normal(0, 1, 4000)]
    calls = []

    def over(f):
        calls.append(1)
        return f(text[60:], meta[60:])

    m = quality_cotrain.co_train(text[:60], meta[:60], y[:60], over)
    p = m.combine(m.views[0].margin(text[60:]), m.views[1].margin(meta[60:]))
    assert len(calls) == quality_cotrain.ROUNDS * (1 + quality_cotrain.STEPS) and ((p >= 0.5) == y[60:]).mean() > 0.97 and len(m.scales) == 2
