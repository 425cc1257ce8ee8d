"""Documents to packed token ids, in five stages; each works on what the last kept.

A stage takes ``(spark, docs, sf_dir)``. ``run`` writes each result as Parquet in
the shared folder and reads it again as the next stage's documents.
"""

from __future__ import annotations

from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.llm import codes, decontam, mixing, quality, similar
from bazaarlake.llm.common import written
from bazaarlake.llm.tokens import tokenizer_path
from bazaarlake.session import passing


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base or the adaptive thresholds reject go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts that share 0.8 of their 5-word shingles the smallest doc_id stays."""
    return similar.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.clean(docs, items)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy of a document that the mix takes."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the mix in its file format, read back: a row per copy."""
    manifest = codes.write(docs, tokenizer_path(), end_id=2)
    return codes.read(manifest, with_ids=False).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.col("crc32").alias("ids_crc32")
    )


STAGES = [
    ("quality", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_leaks),
    ("mixing", source_mix),
    ("token_ids", token_ids),
]

# Tokenizing and fingerprints are beyond SQL; tests run the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what a stage wrote goes once the next has read it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = ExitStack()
    for name, stage in STAGES[:-1]:
        this = ExitStack()
        docs = this.enter_context(passing(stage(spark, docs, sf_dir), name))
        before.close()
        before = this
    name, stage = STAGES[-1]
    with before:
        return written(stage(spark, docs, sf_dir), name)
