"""A corpus pipeline: quality, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written and read again as the next stage's docs.
All but the last return the columns of ``documents``.

Defined cases, for every stage: null, empty and very long texts pass through as their operator defines; null and repeated
ids are rows of their own; an empty table gives no rows; extra columns of docs, whatever their names, are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fringelake.llm import decontaminate_winnow, line_chunks, oph_minhash, pack_slack, quality_cotrain
from fringelake.llm.common import dropped, read, stored
from fringelake.llm.tokens import vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SHARE = 80  # per cent of the union from which near_dedup links


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; without labels of both kinds the labels' share decides for all, and without any label all stay."""
    labels, pages = read(spark, sf_dir, "labels"), read(spark, sf_dir, "pages")
    model = quality_cotrain.fit(docs, labels, pages)
    return quality_cotrain.scored(docs, model, pages, keep_text=True).where("predicted = 1").select(COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go, but for the first of each; no row goes, and a null text stays null."""
    out = line_chunks.line_dedup(docs).withColumn("text", F.col("_cut.kept"))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_row``: the id where all rows have one of their own; else a number in the order of id and text, null ids last."""
    if docs.where("doc_id is null").isEmpty() and docs.groupBy("doc_id").count().where("count > 1").isEmpty():
        return docs.withColumn("_row", F.col("doc_id").cast("long"))
    return stored(docs.sort(F.col("doc_id").asc_nulls_last(), "text").withColumn("_row", F.monotonically_increasing_id()), "numbered")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays, whether ids are null, repeated or neither; documents of a similarity of 0.8 or more are linked."""
    docs = numbered(docs)
    gone = stored(oph_minhash.near_duplicates(docs, doc="_row", share=SHARE).where("not kept").select(F.col("doc_id").alias("_row")).distinct(), "gone")
    return docs.join(gone, "_row", "left_anti").select(COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated rows go, whether ids are null, repeated or neither."""
    docs = numbered(docs)
    found = decontaminate_winnow.decontaminate(docs, read(spark, sf_dir, "benchmark"), doc="_row")
    gone = stored(found.where("contaminated").select(F.col("doc_id").alias("_row")).distinct(), "gone")
    return docs.join(gone, "_row", "left_anti").select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids, packed into sequences; null and empty texts are an end id each."""
    return pack_slack.pack(docs, vocabulary())


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", packing)]

#: The classifier, the chunks and the tokenizer have no SQL; near-dedup, decontamination and packing are tested on planted
#: rows and by their operators' queries, which have SQL or plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the stages make of ``documents``; a stage's table goes when the next one's is written."""
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        if before is not None:
            dropped(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
