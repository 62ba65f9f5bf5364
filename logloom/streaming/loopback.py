"""Reminders that carry what is pending through the bus itself.

The stateless form of :mod:`logloom.streaming.unpaid`: a batch judges only the
records it reads.  An order that is not paid and not yet due, and a payment
without an order, are published again, as ``order2`` and ``pay2`` records, to
the bus that the query reads, so the next batch meets them with the records
that arrived since.  What a batch publishes is a folder of the batch's id: a
batch that is replayed after a failure finds it complete and publishes
nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.operators.orders import CARRIED_ORDER_MARKER, ORDER_TOPICS, PAYMENT_TOPICS, payment_record_parse, \
    route_topics
from logloom.session import folders
from logloom.streaming.bus import BUS_SCHEMA
from logloom.streaming.unpaid import OPEN, STATE, WAITING, judge_batch, wall_clock


def pending_records(judged: DataFrame, batch: DataFrame) -> DataFrame:
    """Bus rows (without offsets) that carry a batch's pending records on: open
    orders as ``userId,orderid,nothing,ordertime``, waiting payments as their
    first fields ``orderid,payment,paymenttime``, one per order id."""
    orders = judged.where(F.col("verdict") == OPEN).select(
        F.lit(ORDER_TOPICS[1]).alias("topic"), "orderid", F.concat_ws(
            ",", F.coalesce("userid", F.lit("")), "orderid", F.lit(CARRIED_ORDER_MARKER), "ordertime")
        .alias("value"))
    fields = payment_record_parse(route_topics(batch, PAYMENT_TOPICS)).groupBy("orderid").agg(
        F.min(F.struct("paymenttime", "payment")).alias("p"))
    payments = judged.where(F.col("verdict") == WAITING).select("orderid").join(fields, "orderid").select(
        F.lit(PAYMENT_TOPICS[1]).alias("topic"), "orderid", F.concat_ws(
            ",", "orderid", F.coalesce("p.payment", F.lit("")), F.coalesce("p.paymenttime", F.lit("")))
        .alias("value"))
    return orders.unionByName(payments).select(
        "topic", F.lit(None).cast("int").alias("partition"), F.lit(None).cast("bigint").alias("offset"),
        F.lit(None).cast("timestamp_ntz").alias("timestamp"), F.col("orderid").alias("key"), "value")


def publish_once(records: DataFrame, epoch_id: int, bus: str) -> bool:
    """Add a batch's records to the bus folder; False when they are there."""
    name = f"carried-{epoch_id}"
    if name in folders(records.sparkSession, bus, complete=True):
        return False
    records.write.mode("overwrite").parquet(f"{bus}/{name}")
    return True


def loopback_batch(batch: DataFrame, epoch_id: int, root: str, bus: str,
                   clock: Callable[[DataFrame, int], datetime] = wall_clock,
                   publish: Callable[[DataFrame, int], object] | None = None, **kw) -> None:
    """``foreachBatch`` sink: verdicts to ``root/batch=<id>``, pending records
    back to ``bus`` (or to ``publish(records, id)``, such as a Kafka topic)."""
    spark = batch.sparkSession
    batch = batch.persist()
    try:
        judged = judge_batch(batch, None, clock(batch, epoch_id), **kw)
        judged.write.mode("overwrite").partitionBy("verdict").parquet(f"{root}/batch={epoch_id}")
        judged = spark.read.schema(STATE).option("basePath", root).parquet(f"{root}/batch={epoch_id}")
        records = pending_records(judged, batch)
        if publish is None:
            publish_once(records, epoch_id, bus)
        else:
            publish(records, epoch_id)
    finally:
        batch.unpersist()


def looped_stream(spark: SparkSession, bus: str) -> DataFrame:
    """Every folder of the bus, those that the query publishes itself included."""
    return spark.readStream.schema(BUS_SCHEMA).parquet(f"{bus}/*")


def judged_rows(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(STATE).parquet(root)
