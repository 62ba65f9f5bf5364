"""Readers: raw access logs, IP-range files and warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.columns import ipv4_to_long


def log_text_scan(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Access-log text files -> one ``value`` row per line.

    Splittable plain text (or splittable codecs) lets Spark cut large files
    into ``spark.sql.files.maxPartitionBytes`` slices, so scan parallelism
    follows the data size rather than the file count.
    """
    return spark.read.text(path)


def ip_ranges_from_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse ``start_ip end_ip district`` lines (whitespace separated).

    Lines are trimmed and split on runs of whitespace; only lines with
    exactly three fields are kept.  Lines whose addresses are not dotted
    quads of 0..255, or whose start is above their end, are rejected
    (:func:`ip_range_rejects` counts them): one bad line must not widen the
    range table beyond the IP space.
    Output: start_ip BIGINT, end_ip BIGINT, district STRING.
    """
    staged = _range_fields(lines, value_col).where("ok")
    return staged.select("start_ip", "end_ip", "district")


def _quad(s):
    """Whether a string is a dotted quad of numbers 0..255."""
    return F.coalesce(s.rlike(r"^(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
                              r"(\.(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"), F.lit(False))


def _range_fields(lines: DataFrame, value_col: str) -> DataFrame:
    trimmed = F.regexp_replace(F.col(value_col), r"^\s+|\s+$", "")
    f = lines.select(F.split(trimmed, r"\s+").alias("f")).where(F.size("f") == 3)
    lo, hi = F.get(F.col("f"), 0), F.get(F.col("f"), 1)
    # behind a one-row inline, so that later filters on the numbers do not
    # repeat their expressions
    f = f.select(F.inline(F.array(F.struct(
        F.when(_quad(lo), ipv4_to_long(lo)).alias("start_ip"),
        F.when(_quad(hi), ipv4_to_long(hi)).alias("end_ip"),
        F.get(F.col("f"), 2).alias("district")))))
    return f.withColumn("ok", F.coalesce(F.col("start_ip") <= F.col("end_ip"), F.lit(False)))


def ip_range_rejects(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """One row: how many three-field lines were kept and how many rejected."""
    return _range_fields(lines, value_col).agg(
        F.count_if("ok").alias("kept"), F.count_if(~F.col("ok")).alias("rejected"))


def ip_ranges_load(spark: SparkSession, path: str) -> DataFrame:
    """IP-range text file -> (start_ip, end_ip, district)."""
    return ip_ranges_from_lines(log_text_scan(spark, path))


def _is_table_name(s: str) -> bool:
    return "/" not in s and ":" not in s


def table_scan(spark: SparkSession, path: str, columns: list[str] | None = None,
               where: str | None = None, schema=None) -> DataFrame:
    """Project named columns (and optionally filter) from a Parquet folder
    or, when ``path`` is a plain name, a catalog table.

    Projection and filter are declared before any action, so the scan reads
    only these columns, pushes the predicate into the Parquet reader and
    prunes ``partitionBy`` folders when the predicate names a partition
    column.  Passing ``schema`` keeps partition values as written (e.g.
    zero-padded strings) instead of re-inferring their types.
    """
    if _is_table_name(path):
        df = spark.table(path)          # a catalog table
    else:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        df = reader.parquet(path)
    if where:
        df = df.where(where)
    if columns:
        df = df.select(*columns)
    return df
