"""The corpus operators against plain versions, round trips and edge cases."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fringelake.llm import decontaminate_winnow as W
from fringelake.llm import fm_index, line_chunks, merkle, oph_minhash, pack_slack, quality_cotrain, repair_tokens, slot_shards, toxicity_fm
from fringelake.llm.common import Words, components, utf8
from fringelake.llm.tokens import tokens_of, vocabulary

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile("[^\x20\x09-\x0d]+")
PLAIN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

passage = " ".join(f"w{i}é" for i in range(70))
TEXTS = [
    None, "", "  \n\t ", "one", "Two words", passage, "Before it " + passage + " after it", passage.upper(), passage, "x " * 300, "line a\nline b\n\nline c\n" * 5,
    "line a\nline b\n\nline c\n" * 5, "a. b. c.\n" + "ÀÉ ſ " * 20, " ".join(f"q{i}" for i in range(4000)), "\x00 nul \x0b vt   sep", "one", " ".join(f"w{i}é" for i in range(69)) + " other",
]


@pytest.fixture(scope="module")
def docs(spark):
    """Odd ids and texts, an extra column whose name clashes with the operators' own, a repeated row and a null id."""
    rows = [(i * 3, t, "en", "s", len(t or ""), "x") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[5], (None, passage, None, None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def ids_of(text):
    return np.array([*tokens_of(vocabulary()).tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def test_words_agree_with_the_pattern():
    w = Words(*utf8(pa.array(TEXTS)))
    got = [[bytes(w.data[s:e]).decode() for s, e in zip(w.starts[a:b], w.ends[a:b])] for a, b in zip(w.of[:-1], w.of[1:])]
    assert got == [SPACED.findall(t or "") for t in TEXTS]


def test_components(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 102), (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components(e).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 102: 100}


def test_decontamination(spark, docs, empty):
    bench = spark.createDataFrame([(1, passage), (2, "two"), (3, " ".join(f"w{i}é" for i in range(20, 40))), (4, None), (None, "one"), (10, "Q7 q8 q9")], "item_id long, text string")
    items = [(r.item_id, PLAIN.findall((r.text or "").translate(LOW))) for r in bench.collect()]
    for limit in (500_000, 0):  # broadcast and shuffled
        got = sorted(W.decontaminate(docs, bench, broadcast_rows=limit).collect(), key=str)
        want = []
        for r in docs.collect():
            w = PLAIN.findall((r.text or "").translate(LOW))
            hit, found = set(), set()
            for i, x in items:
                m = min(13, len(x))
                windows = {tuple(x[s : s + m]) for s in range(len(x) - m + 1)} if m else set()
                at = [s for s in range(len(w) - m + 1) if m and tuple(w[s : s + m]) in windows]
                hit |= {k for s in at for k in range(s, s + m)}
                found |= {i} if at and i is not None else set()
            want.append((r.doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
        assert [tuple(r) for r in got] == [tuple(r) for r in sorted(want, key=lambda x: str(got[0].__class__(*x)))] or Counter(map(tuple, got)) == Counter(want)
    assert W.decontaminate(empty, bench).count() == 0
    assert W.decontaminate(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_words_are_encoded_as_the_tokenizer_encodes_texts():
    rng = np.random.default_rng(5)
    letters = np.array(list("aZé'ÉßsStlL1.,%<|> \n\x1c\x85éİΣ"))
    texts = ["It's we'll'd ''s 'S 12ab3", "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b", "İstanbul ΣΑΣ ﬁ ªº µ ×÷", "a\x00b \x1c\x1d x\x85y \u3000k \u2028", "日本語 中文。 naïve-café", *TEXTS]
    texts += ["".join(rng.choice(letters, n)) for n in rng.integers(1, 25, 3000)]
    ids, bounds = tokens_of(vocabulary()).encode(*utf8(pa.array(texts, pa.large_string())))
    for text, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
        assert ids[a:b].tolist() == ids_of(text).tolist(), text


def test_repair_round_trip(spark, docs, empty):
    rng = np.random.default_rng(0)
    ids = rng.choice([5, 6, 7, 49407], 5000, p=[0.5, 0.3, 0.1, 0.1]).astype(np.uint16)
    bounds = np.array([0, 1, 700, 4000, 5000])
    b = repair_tokens.Block(repair_tokens.to_bytes([None, 1, 2, 2**62], ids, bounds, tokens_of(vocabulary()).size))
    assert b.doc_ids == [None, 1, 2, 2**62] and len(b.symbols) < 3000
    assert (b.expand(b.symbols) == ids).all()
    pairs = Counter()  # the grammar is complete: no pair of neighbours in a document occurs twice apart
    for a, e in zip(b.places[:-1], b.places[1:]):
        at = {}
        for i, p in enumerate(zip(b.symbols[a : e - 1].tolist(), b.symbols[a + 1 : e].tolist())):
            if at.get(p) != i - 1:
                pairs[p] += 1
                at[p] = i
    assert max(pairs.values()) == 1
    for d, s, e in ((1, 0, 5), (2, 100, 333), (2, 3299, 9999), (3, 50, 50)):
        assert (b.ids(d, s, e) == ids[bounds[d] : bounds[d + 1]][s:e]).all()
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
    want, at = [], 0
    for r in rows:
        x = ids_of(r.text)
        want.append((r.doc_id, at, len(x), zlib.crc32(x.tobytes())))
        at += len(x)
    assert Counter(map(tuple, repair_tokens.decode(repair_tokens.encode(docs, vocabulary(), block=64)).collect())) == Counter(want)
    assert repair_tokens.decode(repair_tokens.encode(empty, vocabulary())).count() == 0


def test_merkle(spark, docs, empty):
    got = merkle.fingerprints(docs).collect()
    assert len(got) == docs.count()
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is None, -(r.doc_id or 0)))
    want = {}
    for r, n in zip(rows, rows[1:] + rows[:1]):
        t, u = r.text or "", n.text or ""
        h = len(t) // 2
        want.setdefault(r.doc_id, []).append((len(t), hashlib.sha256((t[: len(t) - h] + u[:h]).encode()).hexdigest(), merkle.fingerprint(t), merkle.likeness(merkle.fingerprint(t), merkle.fingerprint(u))))
    for r in got:
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.near_next) in want[r.doc_id]
        assert r.near_edited == merkle.likeness(r.fingerprint, r.edited_fingerprint) and 0 <= r.near_edited <= 1
    assert merkle.fingerprints(empty).count() == 0
    a, b = merkle.fingerprint("p\nq\n\nr"), merkle.fingerprint("p\nz\n\nr")
    assert merkle.edits(a, b) == [(0, 1, 0)] and merkle.edits(a, a) == [] and merkle.fingerprint("a. b") != merkle.fingerprint("a\nb")


def test_line_chunks(spark, empty):
    block = "\n".join(f"shared line {i}" for i in range(12))
    d = spark.createDataFrame([(i, f"own {i}\nmore {i}\nand {i}\n{block}\nend {i}", "en", "s", 1, "x") for i in range(6)] + [(9, None, None, None, None, None), (10, "one line", "en", "s", 8, "x")], SCHEMA)
    got = {r.doc_id: r for r in line_chunks.line_dedup(d).select("doc_id", "text", "words", "_cut.*").collect()}
    seen = set()
    for k in range(6):
        kept = []
        for c in line_chunks.chunks(got[k].text):
            if len(c) < 2 or tuple(c) not in seen:
                kept += c
            seen.add(tuple(c))
        assert got[k].kept == "\n".join(kept) and got[k].n_removed == len(got[k].text.split("\n")) - len(kept)
    assert got[0].n_removed == 0 and got[5].n_removed > 0 and got[9].kept is None and got[10].kept == "one line" and got[10].words == "x"
    assert line_chunks.line_dedup(empty).count() == 0


def test_slots(spark, docs, empty):
    m = slot_shards.first_map(spark, 16)
    g = slot_shards.grown_map(m, 16)
    got = slot_shards.place(docs, m, g).collect()
    assert len(got) == docs.count()
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert all(r.grown_shard in (r.shard, 16) for r in got)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    share = [r["count"] for r in g.groupBy("shard").count().collect()]
    assert len(share) == 17 and max(share) - min(share) <= 16 and slot_shards.place(empty, m, g).count() == 0


def test_rebalance_and_versions(spark, tmp_path):
    m = slot_shards.first_map(spark, 4, 64)
    loads = spark.range(64).select(F.col("id").cast("int").alias("slot"), F.when(F.col("id") % 4 == 0, 1000).otherwise(100).alias("bytes"))
    r = slot_shards.rebalanced_map(m, loads)
    by = [x.b for x in r.join(loads, "slot").groupBy("shard").agg(F.sum("bytes").alias("b")).collect()]
    assert max(by) <= 1.1 * sum(by) / 4 and {x.version for x in r.collect()} == {2}
    slot_shards.save_map(m, str(tmp_path / "m"))
    slot_shards.save_map(r, str(tmp_path / "m"))
    assert {tuple(x) for x in slot_shards.load_map(spark, str(tmp_path / "m")).collect()} == {tuple(x) for x in r.collect()}
    assert slot_shards.load_map(spark, str(tmp_path / "m"), 1).count() == 64


def test_toxicity_learns_pairs(spark, docs, empty):
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for _ in range(3000):  # toxic only together: no linear weight tells
        a, b = rng.integers(0, 2, 2)
        rows.append(np.unique(np.r_[[1] if a else [2], [3] if b else [4], rng.integers(10, 30, 3)]).astype("<i4"))
        labels.append(float(a != b))
    m = toxicity_fm.train(rows, np.array(labels))
    feature = np.concatenate(rows).astype(np.int64)
    p = m.score(np.repeat(np.arange(len(rows)), [len(r) for r in rows]), feature, len(rows))
    assert ((p >= 0.5) == np.array(labels)).mean() > 0.95
    none = toxicity_fm.train([], np.zeros(0))
    got = toxicity_fm.score(docs, none).collect()
    assert len(got) == docs.count() and all(r.score == 0.5 for r in got) and toxicity_fm.score(empty, none).count() == 0


def test_quality_and_toxicity_on_held_out_rows(spark):
    t = {n: spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels", "pages")}
    d = t["documents"].join(F.broadcast(t["labels"]), "doc_id").where("doc_id < 4000")
    q = quality_cotrain.scored(d, quality_cotrain.fit(d, t["labels"], t["pages"]), t["pages"]).where(toxicity_fm.held_out(F.col("doc_id"))).select("quality", "predicted").toPandas()
    assert (q.quality == q.predicted).mean() > 0.95
    x = toxicity_fm.score(d, toxicity_fm.fit(d, t["labels"])).join(t["labels"], "doc_id").where(toxicity_fm.held_out(F.col("doc_id"))).toPandas()
    assert (x.toxic == x.predicted).mean() > 0.93 and (x.predicted[x.toxic == 1]).mean() > 0.4


def test_quality_edges(spark, docs, empty):
    pages, labels = spark.createDataFrame([(0, None, None), (0, "https://a.org/b", "<a ><p>")], "page_id long, url string, html string"), spark.createDataFrame([(0, 1), (3, None)], "doc_id long, quality int")
    m = quality_cotrain.fit(docs, labels, pages)
    got = quality_cotrain.scored(docs, m, pages).collect()
    assert len(got) == docs.count() and all(r.score == 1.0 for r in got) and quality_cotrain.scored(empty, m, pages).count() == 0


def brute_passages(rows, n=50):
    first, out = {}, {}
    for k, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        w = SPACED.findall(text or "")
        gone, own = set(), []
        for s in range(len(w) - n + 1):
            own.append(tuple(w[s : s + n]))
            if first.get(own[-1], k) != k:
                gone |= set(range(s, s + n))
        for x in own:
            first.setdefault(x, k)
        out[k] = (len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())
    return out


def test_passages(spark, docs, empty):
    want = brute_passages([(r.doc_id, r.text) for r in docs.collect()])
    got = fm_index.repeated_passages(docs).collect()
    assert len(got) == docs.count() and all(tuple(r)[1:] == want[r.doc_id] for r in got)
    assert fm_index.repeated_passages(empty).count() == 0


def test_index_against_plain_search():
    rng = np.random.default_rng(2)
    texts = [rng.integers(1, 4, rng.integers(6, 60)).astype(np.uint64) for _ in range(120)]
    owners = rng.integers(0, 40, len(texts))
    owners = np.unique(owners, return_inverse=True)[1]
    got = fm_index.Index(texts, owners).repeated(texts, owners, window=6)
    least: dict = {}
    for t, o in zip(texts, owners):
        for s in range(len(t) - 5):
            least[tuple(t[s : s + 6])] = min(o, least.get(tuple(t[s : s + 6]), o))
    for t, o, g in zip(texts, owners, got):
        assert g.tolist() == [least[tuple(t[s : s + 6])] < o for s in range(len(t) - 5)]


def test_near_duplicates(spark, docs, empty):
    sets = {}
    for r in docs.where("doc_id is not null").collect():
        w = SPACED.findall((r.text or "").translate(LOW))
        sets[r.doc_id] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    group = {k: k for k in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
    got = oph_minhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is None:
            assert r.kept and r.component_id is None
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), group[r.doc_id], group[r.doc_id] == r.doc_id)
    assert oph_minhash.near_duplicates(empty).count() == 0


def test_near_copies_that_only_their_original_links(spark):
    """A thousand copies, each 0.905 alike to an original with a middle id and about 0.82 to one another."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(304)]
    rows = [(500, " ".join(words))]
    for i in [i for i in range(1001) if i != 500]:
        copy = list(words)
        for at in rng.integers(0, 60, 3) + (5, 120, 235):
            copy[at] = f"c{i}x{at}"
        rows.append((i, " ".join(copy)))
    got = oph_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 1001 and {r.n_shingles for r in got} == {300} and {r.component_id for r in got} == {0}
    assert [r.doc_id for r in got if r.kept] == [0]


def test_packing(spark, docs, empty):
    assert sum(k * v for k, v in pack_slack.fill(100, {60: 1, 45: 2, 10: 1, 7: 3}).items()) == 100
    for counts in ({5: 3, 7: 2, 64: 1}, {33: 50, 31: 1}):
        left = Counter(counts)
        for use, times in pack_slack.patterns(counts, 64):
            assert sum(k * v for k, v in use.items()) <= 64
            left.subtract({k: v * times for k, v in use.items()})
        assert not +left and not -left
    got = pack_slack.pack(docs, vocabulary(), capacity=512).collect()
    for s in {r.sequence_id for r in got}:
        at = 0
        for r in sorted((r for r in got if r.sequence_id == s), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 512
    for k in (0, 15, 39):
        x, at = ids_of(TEXTS[k // 3]), 0
        for r in sorted({tuple(r)[:5] for r in got if r.doc_id == k}):
            assert r[1] == at and r[3] == zlib.crc32(x[at : at + r[2]].tobytes()) and r[4] == len(x)
            at += r[2]
        assert at == len(x)
    assert sum(r.length for r in got) == sum(len(ids_of(r.text)) for r in docs.collect()) and pack_slack.pack(empty, vocabulary()).count() == 0


def test_pipeline(spark):
    import corpus_pipeline as P

    names = [n for n, _ in P.STAGES]
    d = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        before = {r.doc_id for r in d.select("doc_id").collect()}
        d = stage(spark, d, SF)
        assert d.columns == P.COLUMNS and {r.doc_id for r in d.select("doc_id").collect()} <= before
    assert names[0] == "quality" and names[-1] == "packing" and d.count() > 100


def test_pipeline_links_at_four_fifths(spark):
    import corpus_pipeline as P

    words = [f"w{i}" for i in range(304)]
    texts = [words, ["c" if i in (50, 100, 150, 200, 250, 300) else w for i, w in enumerate(words)], ["c" if i % 40 == 20 else w for i, w in enumerate(words)]]  # 0.824 and 0.770 alike to the first
    d = spark.createDataFrame([(i, " ".join(t), "en", "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in P.near_dedup(spark, d, SF).collect()} == {0, 2}


def test_texts_that_share_an_id_or_have_none(spark):
    """Places of one text are not those of another."""
    shared, block = [f"s{i}" for i in range(60)], "\n".join(f"shared line {i}" for i in range(12))
    far = " ".join([f"l{i}" for i in range(400)] + shared)
    texts = [(1, " ".join(shared)), (None, far), (None, "few words"), (None, " ".join([f"m{i}" for i in range(70)])), (7, far + " end"), (7, " ".join(f"n{i}" for i in range(55)))]
    got = {r.kept for r in fm_index.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string"), with_text=True).collect()}
    assert {texts[i][1] for i in (0, 2, 3, 5)} <= got and len(got) == 6
    assert sum("s0 " in f"{t} " for t in got) == 1
    rows = [(1, block), (None, block), (None, "\n".join(f"unique {i}" for i in range(12))), (7, block), (7, "\n".join(f"own {i}" for i in range(12)))]
    cut = {r.text: r for r in line_chunks.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).select("text", "_cut.*").where("text not like 'shared%'").collect()}
    assert len(cut) == 2 and all(r.kept == t and r.n_removed == 0 for t, r in cut.items())


def test_pipeline_removes_rows_with_null_and_repeated_ids(spark):
    import corpus_pipeline as P

    item = max((r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()), key=len)
    copy, clean = " ".join(f"w{i}" for i in range(60)), [" ".join(f"{c}{i}" for i in range(60)) for c in "xyz"]
    rows = [(3, copy), (3, copy), (None, copy), (None, copy), (None, clean[0]), (None, item), (4, item), (4, clean[1]), (None, clean[2])]
    d = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    near, rest = P.near_dedup(spark, d, SF), P.decontamination(spark, d, SF)
    key = lambda rows: Counter((r.doc_id, r.text) for r in rows)
    assert near.columns == rest.columns == P.COLUMNS
    assert key(near.collect()) == Counter([(3, copy), (None, clean[0]), (4, item), (4, clean[1]), (None, clean[2])])
    assert key(rest.collect()) == Counter(r for r in rows if r[1] != item)
