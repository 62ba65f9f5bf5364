"""Lazily built inputs of one scale-factor folder.

The inputs that a deployment would find as files - the raw access log, the
prepared IP lookup, the order bus, the marts - are landed once per application
under the shared folder and read from there, as splittable files of known size.
A landed table belongs to the names, sizes and times of the files it was made
from: a rewritten folder is landed anew.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.functions.parse import access_log_parse
from logloom.operators.dims import time_dimension_of
from logloom.operators.enrich import enrich_loginfo2
from logloom.operators.geo import bucketed_ranges
from logloom.operators.star import star_join_ip, star_join_pv, star_join_uv
from logloom.plans import etl
from logloom.session import remove, table_path, work_dir
from logloom.sources import derived
from logloom.sources.text import ip_ranges_from_lines, log_text_scan

TABLES = ["events", "nation", "region", "orders", "lineitem", "customer"]

# landed tables of this application: (application, folder, fingerprint, name) -> path
_LANDED: dict[tuple[str, str, str, str], str] = {}


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(table_path(self.sf_dir, name))

    @cached_property
    def fingerprint(self) -> str:
        """Digest of the names, sizes and times of the input files: listed, not
        read, and summed up by the tasks that list them."""
        listed = self.spark.read.format("binaryFile").load(
            [table_path(self.sf_dir, name) for name in TABLES])
        one = F.xxhash64("path", "modificationTime", "length")
        return "-".join(map(str, listed.agg(F.count(F.lit(1)), F.sum(F.col("length")), F.bit_xor(one),
                                            F.sum(F.pmod(one, F.lit(1 << 40)))).first()))

    def landed(self, name: str, write: Callable[[str], None]) -> str:
        """Path of a landed table, written by ``write(path)`` on first use."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, self.fingerprint, name)
        if key not in _LANDED:
            path = work_dir(self.spark, "landed", name, unique=True)
            write(path)
            _LANDED[key] = path
        return _LANDED[key]

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def nation(self) -> DataFrame:
        return self.table("nation")

    @cached_property
    def region(self) -> DataFrame:
        return self.table("region")

    @cached_property
    def lines(self) -> DataFrame:
        """The raw access log, landed as text."""
        return log_text_scan(self.spark, self.landed(
            "access_log", derived.access_log_lines(self.events).write.text))

    @cached_property
    def range_lines(self) -> DataFrame:
        return derived.ip_range_lines(self.nation, self.region)

    @cached_property
    def ranges(self) -> DataFrame:
        return ip_ranges_from_lines(self.range_lines)

    @cached_property
    def ip_lookup(self) -> DataFrame:
        """Segments of the IP ranges, prepared once as an ETL run would."""
        return self.spark.read.parquet(self.landed(
            "ip_lookup", bucketed_ranges(self.ranges).write.parquet))

    @cached_property
    def parsed(self) -> DataFrame:
        return access_log_parse(self.lines)

    @cached_property
    def loginfo(self) -> DataFrame:
        return etl.loginfo(self.lines, lookup=self.ip_lookup)

    @cached_property
    def loginfo2(self) -> DataFrame:
        return enrich_loginfo2(self.loginfo)

    @cached_property
    def dims(self) -> derived.Dimensions:
        calendar = self.spark.read.parquet(self.landed(
            "calendar", lambda path: time_dimension_of(self.events).coalesce(1).write.parquet(path)))
        return derived.dimensions(self.spark, self.nation, calendar)

    @cached_property
    def facts_pv(self) -> DataFrame:
        return star_join_pv(self.loginfo2, self.dims)

    @cached_property
    def facts_ip(self) -> DataFrame:
        return star_join_ip(self.loginfo2, self.dims)

    @cached_property
    def facts_uv(self) -> DataFrame:
        return star_join_uv(self.loginfo2, self.dims, with_tiebreak=True)

    @cached_property
    def bus_root(self) -> str:
        """The order bus as its records are kept: ``records/segment=<n>`` with
        a file each, and ``index``, which positions each segment holds."""
        def write(root: str) -> None:
            raw = f"{root}-raw"  # read three times: counted, segmented, numbered
            derived.bus_records(self.table("orders"), self.table("lineitem"),
                                self.table("customer")).write.parquet(raw)
            segmented = derived.with_segments(self.spark.read.parquet(raw))
            derived.segment_counts(segmented).coalesce(1).write.parquet(f"{root}/index")
            counts = self.spark.read.schema(derived.INDEX_SCHEMA).parquet(f"{root}/index")
            # numbered in the order in which they are kept, and not sorted once more
            derived.with_offsets(segmented, counts).write.partitionBy("segment").parquet(f"{root}/records")
            remove(self.spark, raw)
        return self.landed("bus", write)

    @cached_property
    def bus_index(self) -> DataFrame:
        return self.spark.read.schema(derived.INDEX_SCHEMA).parquet(f"{self.bus_root}/index")

    @cached_property
    def bus_size(self) -> int:
        """How many records the bus holds, by its index."""
        return self.bus_index.agg(F.sum(F.col("until_offset") - F.col("from_offset"))).first()[0] or 0

    @cached_property
    def bus_segments(self) -> DataFrame:
        """Bus rows with the number of their segment."""
        return self.spark.read.schema(T.StructType([*derived.BUS_SCHEMA, T.StructField("segment", T.IntegerType())])).parquet(
            f"{self.bus_root}/records")

    @cached_property
    def bus(self) -> DataFrame:
        return self.bus_segments.drop("segment")

    @cached_property
    def status_time(self) -> str:
        """When the batch status is taken: the time of the last record."""
        return self.bus.agg(F.max("timestamp")).first()[0].isoformat(sep=" ")
