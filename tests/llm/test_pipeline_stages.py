"""The pipeline's stages on their own inputs, against the contracts' SQL and a full run's conservation of tokens."""

import duckdb
import pytest

import corpus_pipeline as P
from fringelake.llm import sql
from fringelake.llm.tokens import tokens_of, vocabulary

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for name in ("documents", "benchmark"):
        c.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return c


def kept(spark, stage):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = stage(spark, docs, SF)
    assert out.columns == P.COLUMNS
    return {r.doc_id for r in out.select("doc_id").collect()}


def test_near_dedup_keeps_one_of_each_group(spark, con):
    want = {r[0] for r in con.execute(f"select doc_id from ({sql.NEAR_DUPLICATES.replace('>= 85', '>= 80')}) where kept").fetchall()}
    assert kept(spark, P.near_dedup) == want and len(want) < con.execute("select count(*) from documents").fetchone()[0]


def test_decontamination_keeps_what_is_clean(spark, con):
    assert kept(spark, P.decontamination) == {r[0] for r in con.execute(f"select doc_id from ({sql.DECONTAMINATION}) where not contaminated").fetchall()}


def test_quality_and_lines_keep_rows_and_columns(spark, con):
    every = {r[0] for r in con.execute("select doc_id from documents").fetchall()}
    assert kept(spark, P.line_dedup) == every and kept(spark, P.quality) <= every
    clash = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "1 as _row", "2 as _cut", "3 as predicted", "4 as node")
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, clash, SF).columns == P.COLUMNS
    none = clash.limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, none, SF).count() == 0


def test_run_packs_every_token_of_what_is_left(spark):
    got = P.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.select(P.COLUMNS).schema)
    left = {r.doc_id: len(tokens_of(vocabulary()).tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs.collect()}
    packed: dict = {}
    for r in got:
        packed[r.doc_id] = packed.get(r.doc_id, 0) + r.length
    assert packed == left and len(left) > 50
