"""Composed jobs: raw log -> loginfo -> loginfo2, and the table writers.

The stages are one lazily composed DataFrame graph; Catalyst pushes the
status / static-resource filters below the IP lookup (the reference ran
them after it), prunes unused columns and fuses the row-level work into
whole-stage code generation.  Durable stage boundaries are Parquet tables
written with dynamic partition overwrite, which also cut lineage for long
chains and make a rerun after executor loss idempotent.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions import columns as C
from logloom.functions.parse import access_log_parse
from logloom.operators.filters import drop_error_status, drop_static_resources
from logloom.operators.geo import ip_to_district

LOGINFO_COLUMNS = ["ip", "district", "sessionid", "datetime", "daystr", "url",
                   "status", "sentBytes", "referal", "userAgent"]
YMD = ["year", "month", "day"]


def loginfo(lines: DataFrame, ranges: DataFrame | None = None, value_col: str = "value",
            lookup: DataFrame | None = None) -> DataFrame:
    """ETL stage 1: parse, drop 4xx/5xx and static resources, locate the IP,
    split the partition date into zero-padded strings.

    Output: LOGINFO_COLUMNS + year, month, day (strings, e.g. '01').
    """
    parsed = access_log_parse(lines, value_col)
    kept = drop_static_resources(drop_error_status(parsed))
    located = ip_to_district(kept, ranges, lookup=lookup)
    y, m, d = C.split_ymd_str("yearmonthday")
    return located.select(*LOGINFO_COLUMNS, y.alias("year"), m.alias("month"),
                          d.alias("day"))


# rows per output file: keeps files near a few hundred MB whatever a task holds
MAX_RECORDS_PER_FILE = 5_000_000


def write_partitioned_overwrite(df: DataFrame, path: str,
                                partition_cols: list[str] | None = None,
                                max_records_per_file: int = MAX_RECORDS_PER_FILE) -> None:
    """Overwrite only the partitions present in ``df`` (dynamic overwrite).

    The rows are rebalanced on the partition columns first: AQE merges small
    partitions, so a quiet day is one file, and splits a hot day over several
    tasks, so no day passes through one.  ``maxRecordsPerFile`` bounds file
    size.  Dynamic overwrite commits per partition, so a job retried after
    executor loss leaves the same result and untouched partitions survive.
    """
    partition_cols = partition_cols or YMD
    (df.hint("rebalance", *partition_cols).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .option("maxRecordsPerFile", max_records_per_file)
       .partitionBy(*partition_cols)
       .parquet(path))


def insert_overwrite_table(df: DataFrame, table: str) -> None:
    """``INSERT OVERWRITE TABLE t SELECT *`` into a partitioned catalog
    table: columns by position, partition columns last, and only the
    partitions present in ``df`` replaced (dynamic overwrite).

    Dynamic mode is a session setting for such inserts; it is set in a
    session of its own, so a concurrent insert of the caller's keeps its mode.
    """
    own = df.sparkSession.newSession()
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    view = f"insert_{uuid.uuid4().hex}"
    df.createGlobalTempView(view)
    try:
        own.sql(f"INSERT OVERWRITE TABLE {table} SELECT * FROM global_temp.{view}")
    finally:
        own.catalog.dropGlobalTempView(view)


def write_bucketed_table(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Replace a catalog table that is kept in buckets of ``key``, sorted within
    each: tables of one key and number of buckets join without a shuffle.  The
    rows are dealt to their buckets first, so each bucket is one file."""
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet")
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))


def write_table_overwrite(df: DataFrame, path: str) -> None:
    """Replace a whole table (the marts)."""
    df.write.mode("overwrite").parquet(path)


def row_count(df: DataFrame) -> DataFrame:
    """One-row count of a stage, as a DataFrame (``rows``)."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def preview(df: DataFrame, n: int = 20, order_cols: list[str] | None = None) -> DataFrame:
    """First ``n`` rows: any (reading stops early), or with ``order_cols`` the
    first in that order, so the preview is the same on every run (a top-n
    sort, not a full sort)."""
    return (df.orderBy(*order_cols) if order_cols else df).limit(n)
