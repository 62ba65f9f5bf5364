"""The stream-stream join against the batch status, with late and untimed records."""

from pyspark.sql import functions as F

from logloom.functions import columns as C
from logloom.operators import orders
from logloom.plans.inputs import Inputs
from logloom.session import work_dir
from logloom.streaming import bus as bus_stream
from logloom.streaming import matching

from .conftest import SF_SMALL

BUS = "topic string, partition int, offset long, timestamp timestamp_ntz, key string, value string"


def replay(spark, parts, end):
    """Match the parts of a bus, a batch each, then move the watermark past all."""
    root, folder, checkpoint = (work_dir(spark, "test", n, unique=True) for n in ("matched", "bus", "checkpoint"))
    bus_stream.land_in_order([*parts, matching.heartbeat(spark, end)], folder)
    queries = matching.start_matching(bus_stream.file_bus_stream(spark, folder, 1), root, checkpoint,
                                      trigger={"processingTime": "0 seconds"})
    matching.finish_all(queries)
    state = queries[0].lastProgress.stateOperators[0]
    assert any(m.startswith("rocksdb") for m in state.customMetrics)
    assert state.numRowsDroppedByWatermark == 0 and state.numRowsTotal <= 4  # the heartbeats
    return root


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_expired_and_late_rows_are_written_out(spark):
    import datetime as dt

    def at(hhmm):
        return dt.datetime.strptime(f"2019-09-01 {hhmm}", "%Y-%m-%d %H:%M")

    def order(oid, t, came=None):
        return ("produceOrderInfo", 0, 0, at(came or t), oid, f"u,{oid},a,2019-09-01 {t}:00,1,0,0,1")

    def pay(oid, t, came=None):
        return ("producerOrderids", 0, 0, at(came or t), oid, f"{oid},card,2019-09-01 {t}:00,1,x")
    parts = [[order("in", "10:00"), order("none", "10:00"), order("twice", "10:01")],
             [pay("in", "10:03"), pay("lone", "10:04"), pay("twice", "10:02"), pay("twice", "10:05")],
             [order("later", "12:00"), pay("late", "12:01"), pay("in", "12:02")],
             [order("late", "09:59", came="12:30"), pay("none", "10:04", came="12:31"),
              ("producerOrderids", 0, 0, at("12:32"), "later", "later,card,,1,x"),
              ("produceOrderInfo", 0, 0, at("12:33"), "untimed", "u,untimed,a,n/a,1,0,0,1")],
             [order("open", "13:00"), pay("later", "13:00")]]
    frames = [spark.createDataFrame(p, BUS) for p in parts]
    root = replay(spark, frames, "2019-09-03 00:00:00")
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.unionByName(f)
    assert rows_of(matching.settled(spark, root)) == rows_of(whole.select("topic", "value").distinct())
    late = spark.read.parquet(f"{root}/late")
    assert {r["key"] for r in late.collect()} == {"late", "none", "later", "untimed"}
    met = spark.read.parquet(f"{root}/matched").where("o_value IS NOT NULL AND p_value IS NOT NULL AND p_value NOT LIKE 'heartbeat%'")
    assert sorted(r["o_value"].split(",")[1] for r in met.collect()) == ["in", "twice", "twice"]
    as_of = "2019-09-01 13:02:00"
    want = orders.order_payment_status(orders.orders_from_bus(whole), orders.payments_from_bus(whole), as_of)
    assert rows_of(matching.status_of_matched(spark, root, as_of)) == rows_of(want)
    assert {r["orderid"]: r["status"] for r in want.collect()}["none"] == "paid"  # by a payment that came late


def test_replay_of_the_bus_agrees_with_the_batch_status(spark):
    inp = Inputs(spark, SF_SMALL)
    parts = [inp.bus_segments.where(F.floor(F.col("segment") / 2) == n).drop("segment") for n in range(4)]
    root = replay(spark, parts, "2100-01-01 00:00:00")
    assert rows_of(matching.status_of_matched(spark, root, inp.status_time)) == rows_of(
        orders.order_payment_status(orders.orders_from_bus(inp.bus), orders.payments_from_bus(inp.bus),
                                    inp.status_time))
    # what the join itself says: orders with a timely payment in their window
    met = spark.read.parquet(f"{root}/matched").where("o_value IS NOT NULL AND p_value IS NOT NULL")
    assert met.count() > 0


def test_the_state_has_few_partitions(spark):
    """Stores are opened and committed in every batch, whatever it holds."""
    keep = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    folder, root, checkpoint = (work_dir(spark, "test", n, unique=True) for n in ("bus", "matched", "checkpoint"))
    try:
        bus_stream.land_in_order([matching.heartbeat(spark, "2019-09-01 10:00:00")], folder)
        queries = matching.start_matching(bus_stream.file_bus_stream(spark, folder, 1), root, checkpoint,
                                          trigger={"processingTime": "0 seconds"})
        matching.finish_all(queries)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", keep)
    assert queries[0].lastProgress.stateOperators[0].numShufflePartitions == matching.STATE_PARTITIONS


def test_a_partition_of_the_state_is_one_store(spark):
    """Both sides of the join: four stores before, each committed in every batch."""
    import os
    folder, root, checkpoint = (work_dir(spark, "test", n, unique=True) for n in ("bus", "matched", "checkpoint"))
    bus_stream.land_in_order([matching.heartbeat(spark, "2019-09-01 10:00:00")], folder)
    matching.finish_all(matching.start_matching(bus_stream.file_bus_stream(spark, folder, 1), root, checkpoint,
                                                trigger={"processingTime": "0 seconds"}))
    assert [n for n in os.listdir(f"{checkpoint}/matched/state/0/0") if n.startswith(("left-", "right-"))] == []


def test_the_status_reads_settled_records(spark):
    """The records are settled once, not for each of the status's reads."""
    root = work_dir(spark, "test", "rows", unique=True)
    o, p = ("produceOrderInfo", "u,1,a,2019-09-01 10:00:00,1,0,0,1"), ("producerOrderids", "1,card,2019-09-01 10:01:00,1,x")
    spark.createDataFrame([(*o, *p), (*o, *p)], "o_topic string, o_value string, p_topic string, p_value string").write.parquet(
        f"{root}/matched")
    spark.createDataFrame([("producerOrderids", "1,card,,1,x"), ("producerOrderids", ",heartbeat,"), ("pay2", "heartbeat,,")],
                          "topic string, value string").write.parquet(f"{root}/late")
    assert rows_of(matching.settled(spark, root)) == rows_of(spark.createDataFrame(
        [o, p, ("producerOrderids", "1,card,,1,x")], "topic string, value string"))
    status = matching.status_of_matched(spark, root, "2019-09-01 12:00:00")
    assert [(r["orderid"], r["status"]) for r in status.collect()] == [("1", "paid")]
    assert all("/matched" not in f and "/late" not in f for f in status.inputFiles())


def test_a_time_is_read_only_where_one_can_be(spark):
    times = ["2019-09-01 10:00:00", "", "n/a", None, "2019-09-31 10:00:00", "+12019-09-01 10:00:00", "2019-09-01 10:00:00 "]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in times], "t string").select(
        F.coalesce(C.log_time("t", "yyyy-MM-dd HH:mm:ss").cast("string"), F.lit("-"))).collect()]
    want = [r[0] for r in spark.createDataFrame([(t,) for t in times], "t string").select(F.coalesce(
        F.try_to_timestamp("t", F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz").cast("string"), F.lit("-"))).collect()]
    assert got == want and got[:4] == ["2019-09-01 10:00:00", "-", "-", "-"]
