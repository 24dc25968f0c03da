"""The registered queries: each applies its operator, with production parameters, to the whole of its table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate_winnow, fm_index, line_chunks, merkle, oph_minhash, pack_slack, quality_cotrain, repair_tokens, slot_shards, toxicity_fm
from .common import read, shared_dir, stored
from .sql import oracle_sql as oracle_sql
from .tokens import vocabulary


def op1_cotrained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels, pages = (read(spark, sf_dir, t) for t in ("documents", "labels", "pages"))
    out = quality_cotrain.scored(docs, quality_cotrain.fit(docs, labels, pages), pages)
    return out.select("doc_id", toxicity_fm.held_out(F.col("doc_id")).alias("held_out"), "text_margin", "meta_margin", "score", "predicted")


def op2_winnow_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate_winnow.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_tokens.decode(stored(repair_tokens.encode(read(spark, sf_dir, "documents"), vocabulary()), "repair"))


def op4_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints(read(spark, sf_dir, "documents"))


def op5_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_chunks.line_dedup(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "_cut.n_lines", "_cut.n_chunks", "_cut.n_removed", F.sha2(F.coalesce("_cut.kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op6_slot_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map that decides is a function of the slot and the shard count alone: law ``key``. Both versions are stored, and read back."""
    table = f"{shared_dir(spark)}/slot-maps-{uuid.uuid4().hex}"
    first = slot_shards.first_map(spark, 16)
    slot_shards.save_map(first, table)
    slot_shards.save_map(slot_shards.grown_map(first, 16), table)
    out = slot_shards.place(read(spark, sf_dir, "documents"), slot_shards.load_map(spark, table, 1), slot_shards.load_map(spark, table))
    return out.withColumn("law", F.lit("key")).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "virtual_slot", "slot_bytes", "map_version")


def op7_factorized_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    machine = toxicity_fm.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity_fm.score(docs, machine).select("doc_id", toxicity_fm.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op8_fm_index_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_index.repeated_passages(read(spark, sf_dir, "documents"))


def op9_oph_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oph_minhash.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op10_min_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_slack.pack(read(spark, sf_dir, "documents"), vocabulary())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}
