"""Named queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query reads the warehouse tables of ``sf_dir`` (through
:class:`~logloom.plans.inputs.Inputs`) and returns a lazy DataFrame whose
column names match the DuckDB oracle in ``logloom.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom import schemas
from logloom.functions import columns as C
from logloom.functions import parse as P
from logloom.operators import enrich, geo, marts, offsets, orders
from logloom.operators.dims import time_dimension_of
from logloom.operators.filters import drop_error_status, drop_static_resources
from logloom.operators.star import DIM_IDS
from logloom.plans import etl, jobs
from logloom.plans.inputs import Inputs
from logloom.session import SPLIT_SMALL_FILES, settings, work_dir
from logloom.sources import derived
from logloom.sources.text import table_scan
from logloom.streaming import bus as bus_stream
from logloom.streaming import loopback, matching
from logloom.streaming import offsets as stream_offsets
from logloom.streaming import unpaid

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


# --- sources and sinks ------------------------------------------------------

@query("log_text_scan")
def log_text_scan_q(spark, sf):
    """The derived access log, landed as text and scanned back."""
    return Inputs(spark, sf).lines


@query("ip_ranges_load")
def ip_ranges_load_q(spark, sf):
    return Inputs(spark, sf).ranges


def _write_loginfo(spark, inp: Inputs) -> str:
    path = work_dir(spark, "tables", "loginfo", unique=True)
    etl.write_partitioned_overwrite(inp.loginfo, path)
    return path


@query("write_partitioned_overwrite")
def write_partitioned_overwrite_q(spark, sf):
    """Write loginfo partitioned by (year, month, day); read it back."""
    inp = Inputs(spark, sf)
    path = _write_loginfo(spark, inp)
    return spark.read.schema(schemas.LOGINFO).parquet(path)


@query("insert_overwrite_table")
def insert_overwrite_table_q(spark, sf):
    """Loginfo inserted into a partitioned catalog table, then its first days
    once more: only their partitions are replaced."""
    loginfo = Inputs(spark, sf).loginfo.select(*schemas.LOGINFO.names)
    root = work_dir(spark, "tables", "catalog", unique=True)
    table = f"etl_{root.rsplit('/', 1)[-1]}.loginfo"
    spark.sql(f"CREATE DATABASE {table.split('.')[0]} LOCATION '{root}'")
    loginfo.limit(0).write.partitionBy(*etl.YMD).saveAsTable(table)
    etl.insert_overwrite_table(loginfo, table)
    etl.insert_overwrite_table(loginfo.where(F.col("day") < "04"), table)
    return spark.table(table)


@query("table_scan")
def table_scan_q(spark, sf):
    """Column-pruned scan of the written loginfo table (the stage-2 input)."""
    inp = Inputs(spark, sf)
    path = _write_loginfo(spark, inp)
    return table_scan(spark, path, ["ip", "district", "sessionid", "datetime", "daystr",
                                    "url", "referal", "userAgent"],
                      schema=schemas.LOGINFO)


@query("write_table_overwrite")
def write_table_overwrite_q(spark, sf):
    inp = Inputs(spark, sf)
    path = work_dir(spark, "tables", "pv_day", unique=True)
    etl.write_table_overwrite(marts.pv_mart(inp.facts_pv, "day"), path)
    return spark.read.schema(schemas.PV_MART).parquet(path)


@query("row_count")
def row_count_q(spark, sf):
    return etl.row_count(Inputs(spark, sf).loginfo)


@query("preview")
def preview_q(spark, sf):
    loginfo = Inputs(spark, sf).loginfo
    return etl.preview(loginfo, 20, order_cols=loginfo.columns)


# --- parsing and row-level ETL ------------------------------------------------

@query("access_log_parse")
def access_log_parse_q(spark, sf):
    return Inputs(spark, sf).parsed


@query("access_log_parse_monthly")
def access_log_parse_monthly_q(spark, sf):
    return P.access_log_parse_monthly(Inputs(spark, sf).lines)


@query("weblog_parse_typed")
def weblog_parse_typed_q(spark, sf):
    return P.weblog_parse_typed(Inputs(spark, sf).lines)


@query("request_split_parse")
def request_split_parse_q(spark, sf):
    return P.request_split_parse(derived.combined_log_lines(Inputs(spark, sf).events))


@query("parse_coverage")
def parse_coverage_q(spark, sf):
    return P.parse_coverage(Inputs(spark, sf).lines)


@query("drop_error_status")
def drop_error_status_q(spark, sf):
    return drop_error_status(Inputs(spark, sf).parsed).select(*P.ACCESS_LOG_FIELDS)


@query("drop_static_resources")
def drop_static_resources_q(spark, sf):
    return drop_static_resources(Inputs(spark, sf).parsed).select(*P.ACCESS_LOG_FIELDS)


@query("derive_daystr")
def derive_daystr_q(spark, sf):
    return Inputs(spark, sf).parsed.select("datetime", "daystr", "yearmonthday")


@query("split_ymd_str")
def split_ymd_str_q(spark, sf):
    y, m, d = C.split_ymd_str("yearmonthday")
    return Inputs(spark, sf).parsed.select("yearmonthday", y.alias("year"),
                                           m.alias("month"), d.alias("day"))


@query("split_ymd_int")
def split_ymd_int_q(spark, sf):
    y, m, d = C.split_ymd_int("daystr")
    return Inputs(spark, sf).parsed.select("daystr", y.alias("year"), m.alias("month"),
                                           d.alias("day"))


@query("ipv4_to_long")
def ipv4_to_long_q(spark, sf):
    return Inputs(spark, sf).parsed.select("ip", C.ipv4_to_long("ip").alias("ip_long"))


@query("ip_to_district")
def ip_to_district_q(spark, sf):
    inp = Inputs(spark, sf)
    return geo.ip_to_district(inp.parsed.select("ip"), lookup=inp.ip_lookup)


@query("ip_unresolved_audit")
def ip_unresolved_audit_q(spark, sf):
    inp = Inputs(spark, sf)
    return geo.ip_unresolved_audit(
        geo.ip_to_district(inp.parsed.select("ip"), lookup=inp.ip_lookup))


@query("column_name")
def column_name_q(spark, sf):
    return Inputs(spark, sf).parsed.select("url", C.column_name("url").alias("columnName"))


@query("referer_host")
def referer_host_q(spark, sf):
    """Referer hosts of the log plus those of the crawled page URLs."""
    inp = Inputs(spark, sf)
    refs = inp.parsed.select(F.col("referal"))
    pages = inp.table("pages").select(F.col("url").alias("referal"))
    both = refs.unionByName(pages)
    return both.select("referal", C.referer_host("referal").alias("refererHost"))


@query("device_type")
def device_type_q(spark, sf):
    return Inputs(spark, sf).parsed.select(
        "userAgent", C.device_type("userAgent").alias("deviceType"))


@query("device_type_lookup")
def device_type_lookup_q(spark, sf):
    inp = Inputs(spark, sf)
    return enrich.device_type_lookup(inp.parsed.select("sessionid", "userAgent"),
                                     derived.agent_dictionary(spark))


@query("enrich_loginfo2")
def enrich_loginfo2_q(spark, sf):
    return Inputs(spark, sf).loginfo2


@query("enrich_newloginfo")
def enrich_newloginfo_q(spark, sf):
    inp = Inputs(spark, sf)
    li = inp.loginfo.withColumn("yearmonthday", C.yearmonthday("datetime"))
    return enrich.enrich_newloginfo(li, derived.agent_dictionary(spark))


@query("time_dimension")
def time_dimension_q(spark, sf):
    return time_dimension_of(Inputs(spark, sf).events, "ts")


@query("region_from_ip_json")
def region_from_ip_json_q(spark, sf):
    inp = Inputs(spark, sf)
    # the district depends on the ip alone: de-duplicate before the lookup
    located = geo.ip_to_district(inp.parsed.select("ip").distinct(), lookup=inp.ip_lookup)
    replies = derived.geo_replies(located)
    return replies.select("ip", "reply", C.region_from_ip_json("reply").alias("region"))


# --- joins ------------------------------------------------------------------

@query("star_join_pv")
def star_join_pv_q(spark, sf):
    return Inputs(spark, sf).facts_pv


@query("star_join_ip")
def star_join_ip_q(spark, sf):
    return Inputs(spark, sf).facts_ip


@query("star_join_uv")
def star_join_uv_q(spark, sf):
    return Inputs(spark, sf).facts_uv.drop("daystr")


# --- marts ------------------------------------------------------------------

@query("pv_mart_day")
def pv_mart_day_q(spark, sf):
    return marts.pv_mart(Inputs(spark, sf).facts_pv, "day")


@query("pv_mart_hour")
def pv_mart_hour_q(spark, sf):
    return marts.pv_mart(Inputs(spark, sf).facts_pv, "hour")


@query("ip_mart_day")
def ip_mart_day_q(spark, sf):
    return marts.ip_mart(Inputs(spark, sf).facts_ip)


@query("visit_starts")
def visit_starts_q(spark, sf):
    return marts.visit_starts(Inputs(spark, sf).facts_uv)


@query("uv_mart_day")
def uv_mart_day_q(spark, sf):
    return marts.uv_mart(Inputs(spark, sf).facts_uv)


@query("uv_mart_day_by_days")
def uv_mart_day_by_days_q(spark, sf):
    """The UV mart built in two runs: all days but the last, then the last day
    with what the first run has carried over."""
    inp = Inputs(spark, sf)
    loginfo2 = spark.read.schema(schemas.LOGINFO2).parquet(f"{_marts_root(spark, inp)}/loginfo2")
    root = work_dir(spark, "tables", "uv", unique=True)
    day = F.format_string("%04d%02d%02d", "year", "month", "day")
    # partition values only: a row per folder, and the two newest of them
    newest = [r[0] for r in loginfo2.select(day.alias("d")).distinct().orderBy(F.desc("d")).limit(2).collect()]
    for first, last in ((None, newest[-1]), (newest[0], newest[0])) if len(newest) > 1 else ((None, None),):
        jobs.build_uv(spark, loginfo2, inp.dims, root, first, last)
    return jobs.read_mart(spark, root, "uv_day")


# --- roll-ups and rankings over written marts -----------------------------------

def _marts_root(spark, inp: Inputs) -> str:
    """The written marts of a folder."""
    def write(root):
        stage = f"{root}/loginfo2"
        etl.write_partitioned_overwrite(inp.loginfo2, stage)
        jobs.build_marts(spark, spark.read.schema(schemas.LOGINFO2).parquet(stage), inp.dims, root)
    return inp.landed("marts", write)


def _report_query(name: str) -> Query:
    def run(spark, sf):
        inp = Inputs(spark, sf)
        return jobs.mart_reports(spark, _marts_root(spark, inp), inp.dims)[name]
    return run


REPORTS = [f"{mart}_by_{dim}" for dim in ("device", "column", "referer", "district")
           for mart in ("pv_day", "pv_hour", "uv_day", "ip_day")]
REPORTS += ["ip_day_total", "ip_day_total_exact", "top3_columns_pv_day", "top3_columns_pv_hour",
            "top3_columns_uv_day"]
for _name in REPORTS:
    QUERIES[_name] = _report_query(_name)


# --- orders, payments and the bus -----------------------------------------------

def _bus(inp: Inputs) -> DataFrame:
    return inp.bus


@query("order_record_parse")
def order_record_parse_q(spark, sf):
    return orders.order_record_parse(orders.route_topics(_bus(Inputs(spark, sf)),
                                                         orders.ORDER_TOPICS))


@query("payment_record_parse")
def payment_record_parse_q(spark, sf):
    return orders.payment_record_parse(orders.route_topics(_bus(Inputs(spark, sf)),
                                                           orders.PAYMENT_TOPICS))


@query("delivery_record_parse")
def delivery_record_parse_q(spark, sf):
    inp = Inputs(spark, sf)
    return orders.delivery_record_parse(derived.delivery_records(inp.table("customer")))


@query("order_topic_route")
def order_topic_route_q(spark, sf):
    bus = _bus(Inputs(spark, sf))
    o = orders.route_topics(bus, orders.ORDER_TOPICS).withColumn("stream", F.lit("order"))
    p = orders.route_topics(bus, orders.PAYMENT_TOPICS).withColumn("stream", F.lit("payment"))
    return o.unionByName(p).select("stream", "topic", "partition", "offset", "key")


@query("orders_payments_full_outer")
def orders_payments_full_outer_q(spark, sf):
    bus = _bus(Inputs(spark, sf))
    j = orders.orders_payments_full_outer(orders.orders_from_bus(bus),
                                          orders.payments_from_bus(bus))
    return j.select("orderid", "userid", "ordertime", "payment", "paymenttime")


def _tables(spark, inp: Inputs) -> str:
    """A catalog database with the orders and payments in buckets of their order
    id, located in the shared folder."""
    buckets = max(BUCKETS, -(-inp.bus_size // BUCKET_RECORDS))

    def write(root: str) -> None:
        name = "bus_" + root.rsplit("/", 1)[-1]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{root}'")
        for table, rows in (("orders", orders.orders_from_bus(inp.bus)),
                            ("payments", orders.payments_from_bus(inp.bus))):
            etl.write_bucketed_table(rows, f"{name}.{table}", "orderid", buckets)
    return "bus_" + inp.landed(f"bucketed-{buckets}", write).rsplit("/", 1)[-1]


#: Buckets of the order tables, at least; and records of the bus in a bucket of
#: both, so that the task that joins one holds as much at any size.
BUCKETS, BUCKET_RECORDS = 8, 500_000


@query("orders_payments_bucketed")
def orders_payments_bucketed_q(spark, sf):
    """The same rows from tables kept in buckets: joined without a shuffle."""
    name = _tables(spark, Inputs(spark, sf))
    o, p = spark.table(f"{name}.orders"), spark.table(f"{name}.payments")
    return orders.orders_payments_full_outer(o, p).select("orderid", "userid", "ordertime", "payment", "paymenttime")


@query("orders_payments_salted")
def orders_payments_salted_q(spark, sf):
    """The same rows with every order id of many payments split on both sides."""
    bus = _bus(Inputs(spark, sf))
    j = orders.orders_payments_salted(orders.orders_from_bus(bus), orders.payments_from_bus(bus))
    return j.select("orderid", "userid", "ordertime", "payment", "paymenttime")


def _status(inp: Inputs, bus: DataFrame | None = None, as_of: str | None = None,
            pay_within=orders.REMIND_AFTER) -> DataFrame:
    bus = inp.bus if bus is None else bus
    return orders.order_payment_status(orders.orders_from_bus(bus), orders.payments_from_bus(bus),
                                       as_of or inp.status_time, pay_within=pay_within)


@query("order_payment_status")
def order_payment_status_q(spark, sf):
    return _status(Inputs(spark, sf))


@query("order_payment_status_any_payment")
def order_payment_status_any_payment_q(spark, sf):
    return _status(Inputs(spark, sf), pay_within=None)


@query("carry_forward")
def carry_forward_q(spark, sf):
    return orders.carry_forward(_status(Inputs(spark, sf)))


@query("order_amounts")
def order_amounts_q(spark, sf):
    return orders.order_amounts(order_record_parse_q(spark, sf))


@query("time_interval_seconds")
def time_interval_seconds_q(spark, sf):
    """Order-to-payment latency in seconds."""
    bus = _bus(Inputs(spark, sf))
    o = orders.orders_from_bus(bus).select("orderid", "ordertime")
    p = orders.payments_from_bus(bus).select("orderid", "paymenttime")
    return o.join(p, "orderid").select(
        "orderid", "ordertime", "paymenttime",
        C.time_interval_seconds("paymenttime", "ordertime", "yyyy-MM-dd HH:mm:ss")
        .alias("seconds"))


# --- streams over the kept bus ----------------------------------------------------

def _in_segments(spark, inp: Inputs, name: str) -> str:
    """The bus landed segment by segment, as it would arrive."""
    folder = work_dir(spark, "landing", name, unique=True)
    numbers = range(inp.bus_segments.agg(F.max("segment")).first()[0] + 1)
    bus_stream.land_in_order(
        (inp.bus_segments.where(F.col("segment") == n).drop("segment") for n in numbers), folder)
    return folder


def _reminders(spark, sf, trigger: dict) -> str:
    """Run the reminder stream over the bus, a segment per batch; the folder of
    its verdicts."""
    root = work_dir(spark, "streams", "reminders", "verdicts", unique=True)
    stream = bus_stream.file_bus_stream(spark, _in_segments(spark, Inputs(spark, sf), "reminders"),
                                        max_files_per_trigger=1)
    query = unpaid.start_unpaid_reminders(
        stream, root, work_dir(spark, "streams", "reminders", "checkpoint", unique=True), trigger=trigger,
        clock=unpaid.bus_clock, buckets=4, compact_every=4)
    with settings(spark, SPLIT_SMALL_FILES):
        bus_stream.finish(query)
    return root


@query("unpaid_orders_stream")
def unpaid_orders_stream_q(spark, sf):
    """Reminders of the stream in bounded batches, by the clock of the bus."""
    root = _reminders(spark, sf, {"availableNow": True})
    return unpaid.verdicts(spark, root).select("orderid", "userid", "ordertime")


@query("micro_batch_trigger")
def micro_batch_trigger_q(spark, sf):
    """What each micro-batch of the production trigger (5 seconds) decided, in
    one run of the query."""
    root = _reminders(spark, sf, {"processingTime": "5 seconds"})
    return (unpaid.reminder_state(spark, root).changes()
            .groupBy("batch", "verdict").agg(F.count(F.lit(1)).alias("records")))


#: How far the consumers below read in each partition per batch, and after how
#: many batches the first of them stops.
CONSUMER_STEP, CONSUMER_BATCHES = 5_000, 2


def _consume(spark, inp: Inputs, batches: int | None = None, start: str = "{}",
             topics: list[str] | None = None, rows: str | None = None) -> tuple[str, stream_offsets.BatchReport]:
    """A consumer group that stores its positions with each batch, and the
    report of what the engine read.  It ends after some batches, or when it
    has read all there is; with ``rows``, it writes what it read there."""
    history = work_dir(spark, "tables", "offset_history", unique=True)
    name = f"consumer-{history.rsplit('/', 1)[-1]}"
    report = stream_offsets.BatchReport(spark, name, work_dir(spark, "tables", "report", unique=True))

    def sink(batch: DataFrame, epoch: int) -> None:
        if batches is not None and epoch >= batches:
            return  # stopped before it had stored anything of this batch
        if rows:
            batch = batch.persist()  # else it is read once
        try:
            if rows:
                batch.write.mode("overwrite").parquet(f"{rows}/batch={epoch}")
            stream_offsets.offset_history_append(batch, epoch, history, group="reminders")
        finally:
            if rows:
                batch.unpersist()
    checkpoint = work_dir(spark, "streams", name, "checkpoint", unique=True)
    stream = bus_stream.kept_bus_stream(spark, inp.bus_root, start, checkpoint, CONSUMER_STEP, topics)
    spark.streams.addListener(report)
    try:
        q = (stream.writeStream.queryName(name).foreachBatch(sink).trigger(processingTime="0 seconds")
             .option("checkpointLocation", checkpoint).start())
        if batches is None:
            bus_stream.finish(q)
        else:
            bus_stream.finish_batches(q, batches)
        report.wait(spark, history)
    finally:
        spark.streams.removeListener(report)
    return history, report


def _history(spark, sf) -> DataFrame:
    return stream_offsets.read_history(spark, _consume(spark, Inputs(spark, sf))[0])


def _positions(spark, history: str) -> DataFrame:
    return stream_offsets.newest_positions(spark, history, "reminders").select(
        "topic", "partition", F.col("until_offset").alias("offset"))


@query("order_stream_source")
def order_stream_source_q(spark, sf):
    """What two consumers read: the first stops after some batches, the second
    starts at the positions that the first has stored."""
    inp = Inputs(spark, sf)
    rows = work_dir(spark, "streams", "bus_source", "rows", unique=True)
    history, _ = _consume(spark, inp, CONSUMER_BATCHES, rows=f"{rows}/first")
    start = offsets.starting_offsets_json(offsets.starting_offsets_resolve(
        _positions(spark, history), offsets.index_bounds(inp.bus_index)))
    _consume(spark, inp, start=start, rows=f"{rows}/second")
    both = spark.read.schema(derived.BUS_SCHEMA).parquet(f"{rows}/first")
    return both.unionByName(spark.read.schema(derived.BUS_SCHEMA).parquet(f"{rows}/second")).drop("batch")


@query("stream_batch_offsets")
def stream_batch_offsets_q(spark, sf):
    """Per-micro-batch consumed ranges, written by a foreachBatch sink."""
    return _history(spark, sf).select("batch_id", "topic", "partition", "from_offset", "until_offset", "records")


@query("offset_history_append")
def offset_history_append_q(spark, sf):
    """The saved history of a consumer group, read back after the stream."""
    return _history(spark, sf).select("group", "topic", "partition", "batch_id", "batch_time", "until_offset")


@query("batch_offset_report")
def batch_offset_report_q(spark, sf):
    """One line per batch and topic as the engine reports it: partitions read,
    offsets passed, and the records of the whole batch."""
    _, report = _consume(spark, Inputs(spark, sf))
    passed = F.col("until_offset") - F.col("from_offset")
    return report.rows().groupBy("batch_id", "topic").agg(
        F.count_if(passed > 0).alias("partitions"), F.sum(passed).alias("offsets"), F.max("rows").alias("records"))


@query("batch_record_count")
def batch_record_count_q(spark, sf):
    """Records per micro-batch; a replayed batch counts once."""
    return _history(spark, sf).groupBy("batch_id").agg(F.sum("records").alias("records"))


@query("carry_forward_stream")
def carry_forward_stream_q(spark, sf):
    """What is carried forward by the stream-stream join, a segment per batch;
    at the end a heartbeat moves the watermark past all records."""
    inp = Inputs(spark, sf)
    root, checkpoint = (work_dir(spark, "streams", "matched", n, unique=True) for n in ("rows", "checkpoint"))
    folder = _in_segments(spark, inp, "matched")
    bus_stream.land_in_order([matching.heartbeat(spark, "9999-01-01 00:00:00")], folder)
    with settings(spark, SPLIT_SMALL_FILES):
        matching.finish_all(matching.start_matching(
            bus_stream.file_bus_stream(spark, folder, 1), root, checkpoint, trigger={"processingTime": "0 seconds"}))
    return orders.carry_forward(matching.status_of_matched(spark, root, inp.status_time))


#: Rounds of the looped query.
ROUNDS = 3


@query("pending_sink")
def pending_sink_q(spark, sf):
    """Verdicts of three rounds of one query, which carries what is pending
    through the bus that it reads; the records of a third of the time arrive
    with each round, and the last round's pending records stay in a sink."""
    inp = Inputs(spark, sf)
    root = work_dir(spark, "streams", "looped", "verdicts", unique=True)
    folder = work_dir(spark, "landing", "looped", unique=True)
    segments = inp.bus_segments.agg(F.max("segment")).first()[0] + 1

    def land(n: int) -> None:
        bus_stream.land_bus(inp.bus_segments.where(F.floor(F.col("segment") * ROUNDS / segments) == n)
                            .drop("segment"), f"{folder}/bus/arrived-{n}")

    def sink(batch: DataFrame, epoch: int) -> None:
        last = epoch == ROUNDS - 1
        loopback.loopback_batch(batch, epoch, root, f"{folder}/sink" if last else f"{folder}/bus",
                                clock=unpaid.bus_clock)
        if not last:
            land(epoch + 1)
    land(0)
    q = (loopback.looped_stream(spark, f"{folder}/bus").writeStream.foreachBatch(sink)
         .option("checkpointLocation", work_dir(spark, "streams", "looped", "checkpoint", unique=True))
         .trigger(processingTime="0 seconds").start())
    bus_stream.finish(q)
    return loopback.judged_rows(spark, root).select("batch", "orderid", "userid", "ordertime", "verdict")


# --- offsets ----------------------------------------------------------------------

@query("offset_latest_lookup")
def offset_latest_lookup_q(spark, sf):
    """Saved positions of a consumer that stopped after some batches."""
    return _positions(spark, _consume(spark, Inputs(spark, sf), CONSUMER_BATCHES)[0])


@query("starting_offsets_resolve")
def starting_offsets_resolve_q(spark, sf):
    """Where a consumer of all topics goes on when its group has read some
    batches of all but the carried-forward payments."""
    inp = Inputs(spark, sf)
    history, _ = _consume(spark, inp, CONSUMER_BATCHES, topics=[*orders.ORDER_TOPICS, orders.PAYMENT_TOPICS[0]])
    return offsets.starting_offsets_resolve(_positions(spark, history), offsets.index_bounds(inp.bus_index), "clamp")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw log -> ETL -> star join -> daily PV -> top-3 columns per day."""
    return QUERIES["top3_columns_pv_day"](spark, sf_dir)


__all__ = ["QUERIES", "DIM_IDS", "flagship", "query"]
