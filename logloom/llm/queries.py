"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import (decontaminate, exact_dedup, hard_negatives, license_scan, nnls_packing,
                         packing, quality, ranked_search, secret_scan, sharding, simhash, url_filter, warc)
from logloom.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, sf, "documents"), read(spark, sf, "benchmark"))
    hit = decontaminate.n_hit(F.col("spans"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"))


def op2_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf, "documents"))
    return found.select(F.col("id").alias("doc_id"),
                        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(read(spark, sf, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                        F.col("sha256").alias("text_sha256"))


def op4_quality(spark: SparkSession, sf: str) -> DataFrame:
    found = quality.classify(read(spark, sf, "documents"), read(spark, sf, "labels"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "log_weight", "gumbel_key", "kept")


def op5_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = license_scan.scan_licenses(read(spark, sf, "documents"))
    return found.select(F.col("id").alias("doc_id"), "text_sha256", "whole", "licenses", "n_units")


def op6_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    rules = secret_scan.RULES
    found = secret_scan.scan_secrets(read(spark, sf, "documents"), rules=rules)
    base = [r.kind for r in rules if r.base]

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        F.col("id").alias("doc_id"), *[count(k) for k in base],
        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))


def op7_packing(spark: SparkSession, sf: str) -> DataFrame:
    found = packing.pack(read(spark, sf, "documents"), tokenizer_path())
    return found.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32",
                        "sequence_id", "offset")


def op8_warc(spark: SparkSession, sf: str) -> DataFrame:
    headers, payloads = warc.write_archive(read(spark, sf, "pages"))
    return warc.parsed_records(warc.read_archive(spark, headers, payloads)) \
        .withColumnRenamed("id", "page_id")


def op9_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.filter_urls(read(spark, sf, "pages")).withColumnRenamed("id", "page_id")


def op10_sharding(spark: SparkSession, sf: str) -> DataFrame:
    found = sharding.shard_records(read(spark, sf, "documents"))
    return found.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"),
                        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.mine(rows.select("vec_id", "embedding", label.alias("label")))
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_nnls_packing(spark: SparkSession, sf: str) -> DataFrame:
    found = nnls_packing.pack(read(spark, sf, "documents"), tokenizer_path())
    return found.select(F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens",
                        "sequence_id", "offset")


def op13_ranked_search(spark: SparkSession, sf: str) -> DataFrame:
    found = ranked_search.search(read(spark, sf, "documents"), read(spark, sf, "benchmark"))
    return found.select("item_id", "rank", F.col("id").alias("doc_id"), "score")


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_decontaminate, op2_simhash, op3_exact_dedup, op4_quality, op5_license_scan,
    op6_secret_scan, op7_packing, op8_warc, op9_url_filter, op10_sharding, op11_hard_negatives, op12_nnls_packing,
    op13_ranked_search)}
