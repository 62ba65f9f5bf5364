"""Corpus pipeline: quality, exact dedup, near dedup, decontamination, packing.

Each stage takes what its predecessor kept, and all but the last return the
columns of ``documents``.  Stages are written as Parquet and reread, so a
stage starts from files that every executor sees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import decontaminate, exact_dedup, packing, quality, simhash
from logloom.llm.common import read, scratch, stored
from logloom.llm.queries import tokenizer_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the one with the least id stays."""
    return simhash.drop_near_duplicates(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents of nothing else go."""
    return decontaminate.remove_contamination(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their sequences and offsets."""
    return packing.pack(docs, tokenizer_path()).select(
        F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_classifier", keep_good),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", cut_benchmark),
    ("best_fit_packing", pack),
]

#: Fitted models, fingerprints and tokenizers are beyond SQL; tests hold the
#: stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch(spark, f"scratch_{name}"):  # what the stage stored itself goes with its end
            docs = stored(stage(spark, docs, sf_dir), f"stage_{name}", keep=True)
    return docs
