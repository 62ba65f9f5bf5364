"""Orders matched with their payments by a watermarked stream-stream join.

The state of the join is kept by the engine (RocksDB), bounded by the
watermark: an order leaves it when no payment can be in its window any more, a
payment when no order can.  Both leave as rows of the output - matched, an order
without a payment in its window, or a payment without an order - so what
expires is written out, not lost.

A watermark would drop late rows.  On a bus that is read in order of its own
time, a record that came at most ``delay`` after its event time is never behind
the watermark, and that can be told from the record itself.  All other records,
and those without a readable time, go to a side output and are settled with what
the join has written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions import columns as C
from logloom.operators.orders import (
    ORDER_TOPICS, PAYMENT_TOPICS, REMIND_AFTER, order_payment_status, orders_from_bus, payments_from_bus,
    route_topics,
)
from logloom.session import settings, work_dir
from logloom.streaming.bus import finish

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: A batch uploads what it changed, not a snapshot of the whole store.
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
#: One store a partition, in which both sides of the join have their tables: in
#: the former format a batch opens, commits and uploads four of each.  A query
#: goes on with the format that its checkpoint was begun with.
ONE_STORE = {"spark.sql.streaming.join.stateFormatVersion": "3"}
#: Partitions of the state, at most.  It holds a batch and the records of the
#: watermark's delay, however long the bus is; each partition is a store to
#: open, commit and upload in every batch, and a file of the sink.
STATE_PARTITIONS = 16
#: Key of records that only move the watermark on.
HEARTBEAT = "heartbeat"
_FORMAT = "yyyy-MM-dd HH:mm:ss"


def event_time(topic: str = "topic", value: str = "value") -> Column:
    """The order's or the payment's own time; null when it cannot be read."""
    fields = F.split(F.col(value), ",")
    at = F.when(F.col(topic).isin(ORDER_TOPICS), F.lit(4)).otherwise(F.lit(3))
    return C.log_time(F.try_element_at(fields, at), _FORMAT)


def _timely(delay: str) -> Column:
    def at_most(at: Column) -> Column:
        return (F.col("timestamp") <= at + F.expr(f"INTERVAL {delay}")) & (F.col("timestamp") >= at)
    # bound to a variable, the time is parsed once for both comparisons
    return F.coalesce(F.exists(F.array(event_time()), at_most), F.lit(False))


def late_records(bus: DataFrame, delay: str = "30 minutes") -> DataFrame:
    """The side output: records that may be behind the watermark, or that are
    timed ahead of the bus, or not at all."""
    return route_topics(bus, ORDER_TOPICS + PAYMENT_TOPICS).where(~_timely(delay))


def matched_stream(bus: DataFrame, delay: str = "30 minutes", within: str = REMIND_AFTER,
                   early: str = "10 minutes") -> DataFrame:
    """Full outer join of timely orders and payments within the order's window:
    ``o_topic, o_value, p_topic, p_value`` of the records that met, or one side."""
    rows = bus.where(_timely(delay))
    # the engine's time windows need instants; both sides are read as the same zone
    o = route_topics(rows, ORDER_TOPICS).select(
        F.split("value", ",")[1].alias("o_id"), F.col("topic").alias("o_topic"), F.col("value").alias("o_value"),
        event_time().cast("timestamp").alias("o_ts")).withWatermark("o_ts", delay)
    p = route_topics(rows, PAYMENT_TOPICS).select(
        F.split("value", ",")[0].alias("p_id"), F.col("topic").alias("p_topic"), F.col("value").alias("p_value"),
        event_time().cast("timestamp").alias("p_ts")).withWatermark("p_ts", delay)
    met = ((F.col("o_id") == F.col("p_id"))
           & (F.col("p_ts") >= F.col("o_ts") - F.expr(f"INTERVAL {early}"))
           & (F.col("p_ts") <= F.col("o_ts") + F.expr(f"INTERVAL {within}")))
    return o.join(p, met, "fullOuter").select("o_topic", "o_value", "p_topic", "p_value")


def heartbeat(spark: SparkSession, at: str) -> DataFrame:
    """An order and a payment record of no order at all, timed ``at``: at the end
    of a replay they move the watermark past everything before."""
    rows = [(ORDER_TOPICS[0], f",{HEARTBEAT},,{at}"), (PAYMENT_TOPICS[0], f"{HEARTBEAT},,{at}")]
    return spark.createDataFrame(rows, "topic string, value string").select(
        "topic", F.lit(None).cast("int").alias("partition"), F.lit(None).cast("bigint").alias("offset"),
        F.lit(at).cast("timestamp_ntz").alias("timestamp"), F.lit(HEARTBEAT).alias("key"), "value")


def start_matching(bus: DataFrame, root: str, checkpoint: str, delay: str = "30 minutes",
                   trigger: dict | None = None, **kw) -> list:
    """Start the join and its side output; both write Parquet under ``root``."""
    spark = bus.sparkSession
    few = str(min(STATE_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    # a query keeps the settings it was started with
    with settings(spark, ONE_STORE | {PROVIDER: ROCKSDB, CHANGELOG: "true", "spark.sql.shuffle.partitions": few}):
        return _started(bus, root, checkpoint, delay, trigger, **kw)


def _started(bus: DataFrame, root: str, checkpoint: str, delay: str, trigger: dict | None, **kw) -> list:
    return [(rows.writeStream.option("checkpointLocation", f"{checkpoint}/{name}").outputMode("append")
             .trigger(**(trigger or {"processingTime": "5 seconds"})).format("parquet")
             .option("path", f"{root}/{name}").start())
            for name, rows in (("matched", matched_stream(bus, delay, **kw)), ("late", late_records(bus, delay)))]


def settled(spark: SparkSession, root: str) -> DataFrame:
    """Every order and payment record that the join and its side output wrote,
    once: topic, value.  A record that met several is reduced to one."""
    matched = spark.read.schema("o_topic string, o_value string, p_topic string, p_value string").parquet(
        f"{root}/matched")
    late = spark.read.schema("topic string, value string").parquet(f"{root}/late")
    sides = matched.select(F.inline(F.array(*[
        F.struct(F.col(f"{s}_topic").alias("topic"), F.col(f"{s}_value").alias("value")) for s in "op"])))
    beats = F.startswith("value", F.lit(f",{HEARTBEAT},")) | F.startswith("value", F.lit(f"{HEARTBEAT},"))
    return sides.where(F.col("value").isNotNull()).unionByName(late).distinct().where(~beats)


def status_of_matched(spark: SparkSession, root: str, as_of: str, **kw) -> DataFrame:
    """The batch status of what the stream has written.  Its records are settled
    once and stored, as the status reads them several times."""
    stored = work_dir(spark, "streams", "settled", unique=True)
    settled(spark, root).write.parquet(stored)
    rows = spark.read.schema("topic string, value string").parquet(stored)
    return order_payment_status(orders_from_bus(rows), payments_from_bus(rows), as_of, **kw)


def finish_all(queries: list) -> None:
    for q in queries:
        finish(q)
