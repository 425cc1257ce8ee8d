"""One query for each operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.llm import (
    attribution,
    codes,
    decontam,
    filter_audit,
    language_model,
    merkle,
    mixing,
    onebit,
    quality,
    secrets,
    simhash,
    substrings,
    warc,
)
from bazaarlake.llm.oracles import ORACLES
from bazaarlake.llm.tokens import tokenizer_path

__all__ = ["ORACLES", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document, and those that cross its bounds."""
    got = attribution.count(_table(spark, sf_dir, "documents"), tokenizer_path())
    return got.select(
        F.col("id").alias("doc_id"),
        "section",
        (F.col("end") - F.col("first")).alias("n_bytes"),
        F.col("tokens").cast("bigint").alias("n_tokens"),
        F.col("crossing").alias("n_crossing"),
    )


def op2_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids written as directly addressable codes and read back, per document."""
    manifest = codes.write(_table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)
    return codes.read(manifest, with_ids=False).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.col("crc32").alias("ids_crc32")
    )


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document with the forest's verdict."""
    got = secrets.scan(_table(spark, sf_dir, "documents"))
    return got.withColumnRenamed("id", "doc_id")


def op4_gru_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document by the recurrent model and the base."""
    got = language_model.scores(_table(spark, sf_dir, "documents"))
    return got.withColumnRenamed("id", "doc_id")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated passages of 35 words."""
    return substrings.repeats(_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256"
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents."""
    return decontam.find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_groups(_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op8_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document gives to the mix."""
    return mixing.mix(_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, read back from the archives."""
    index = warc.write(_table(spark, sf_dir, "pages"))
    return warc.read(index, with_payload=False).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    got = quality.verdicts(_table(spark, sf_dir, "documents"), columns=["doc_id"])
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return got.select("row.doc_id", *[f"counts.{c}" for c in counts], "base_failed", "kept")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every filter removes in every order of the five, per source."""
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_onebit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest other vectors of every vector whose id 20 divides."""
    vectors = _table(spark, sf_dir, "embeddings")
    return onebit.search(onebit.build(vectors), vectors.filter("vec_id % 20 = 0"), k=20)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, folded again from its leaf, tampered with for half the ids."""
    docs = _table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars"]
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    changed = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle.leaf_of([*map(F.col, fields), changed])
    got = merkle.manifest(docs, [*fields, "text"], also={"found": found})
    return got.withColumn("folded_root", merkle.folded(F.col("found"), "proof", "steps")).select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2("proof", 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES: dict[str, Query] = {
    "op1_section_tokens": op1_section_tokens,
    "op2_token_codes": op2_token_codes,
    "op3_secret_scan": op3_secret_scan,
    "op4_gru_scores": op4_gru_scores,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_decontamination": op6_decontamination,
    "op7_simhash_groups": op7_simhash_groups,
    "op8_weighted_mix": op8_weighted_mix,
    "op9_warc": op9_warc,
    "op10_adaptive_quality": op10_adaptive_quality,
    "op11_filter_audit": op11_filter_audit,
    "op12_onebit_neighbours": op12_onebit_neighbours,
    "op13_merkle_manifest": op13_merkle_manifest,
}
