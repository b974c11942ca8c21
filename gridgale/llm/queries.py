"""The operators as queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridgale.llm import (
    alignment, collocations, cover_tree, fingerprints, hash_tree, host_quality, licenses, line_dedup, mixing, near_dedup, packing, secrets, toxicity,
)
from gridgale.llm.common import documents, ranked, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = line_dedup.drop_repeated_lines(documents(spark, sf_dir), carry=["doc_id"])
    return deduped.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


@query
def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(documents(spark, sf_dir), carry=["doc_id"])
    return mix.select("row.doc_id", "size", "source_size", "target", "taken")


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(documents(spark, sf_dir), carry=["doc_id"])
    return packed.select("row.doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = licenses.scan_licenses(documents(spark, sf_dir), carry=["doc_id"])
    return scanned.select(
        "row.doc_id", F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct("matches.license")), ",").alias("licenses"),
        F.round(F.coalesce(F.array_max("matches.score"), F.lit(0.0)), 6).alias("best_score"),
    )


@query
def op6_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_quality.judge_documents(documents(spark, sf_dir), carry=["doc_id"])
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score_documents(docs, model, carry=["doc_id"])
    return scored.select(
        "row.doc_id", toxicity.held_out(F.col("row.doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = fingerprints.compare_versions(documents(spark, sf_dir), carry=["doc_id"])
    return compared.select(
        "row.doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint",
        "edited_fingerprint", "near_edited", "near_next",
    )


@query
def op9_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = hash_tree.shard_documents(docs).select("row.*", "shard", "grown_shard")
    slotted = ranked(written(placed, "sharded"), ["shard"], ["doc_id", "text_crc32"], "slot")
    return slotted.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard"
    )


@query
def op10_secret_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = secrets.scan_secrets(documents(spark, sf_dir), carry=["doc_id"])

    def of(kind: str):
        return F.size(F.filter("base", lambda m: m["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scanned.select(
        "row.doc_id", *[of(k) for k in secrets.BASE],
        F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"),
        secrets.joined(F.concat("base", "added")).alias("spans"), "n_credentials",
    )


@query
def op11_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = cover_tree.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), carry=["vec_id"])
    return linked.select("row.vec_id", "n_links", "component_id", "kept")


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = alignment.align_documents(documents(spark, sf_dir), carry=["doc_id"])
    return aligned.select(
        "row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
