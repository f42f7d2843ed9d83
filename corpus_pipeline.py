"""A training corpus from ``documents``: five stages, each one of the operators of hearth.llm.

Defined results: without labels every document passes the classifier; documents without a word
(null or empty texts) are one group of copies and the mix takes nothing of them, so they are not
packed; of equal or near-equal texts the smallest doc_id stays, rows without an id after all
others; rows equal in every column are copies like any other; a text of any length goes through
whole; columns may hold nulls; empty tables give an empty corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hearth.llm import mixing, packing, quality, secret_scan, simhash
from hearth.session import scratch_path


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the clean grade is high enough."""
    return quality.select(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (3-word shingles, up to 3 bits)."""
    return simhash.deduplicate(docs, shingle=3, radius=3)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets masked, but for widely copied examples."""
    return secret_scan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, in training order."""
    return mixing.training_order(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens: a row per piece with its ids."""
    return packing.pack(docs, emit_ids=True)


STAGES = [("quality_classifier", classify), ("simhash_dedup", deduplicate), ("secret_scan", redact),
          ("source_mixing", mix), ("harmonic_packing", pack)]

# Training, XXH64 and tokenizing are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written to the shared folder and reread."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"pipeline-{name}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
