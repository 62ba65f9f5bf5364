"""Order status rules, carry-forward, and stream-vs-batch agreement of the
unpaid-order reminder."""

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from logloom.operators import offsets, orders
from logloom.session import folders, work_dir
from logloom.streaming import bus as bus_stream
from logloom.streaming import loopback
from logloom.streaming import offsets as stream_offsets
from logloom.streaming import unpaid

BUS = "topic string, partition int, offset long, timestamp timestamp_ntz, key string, value string"


def _bus(spark, rows):
    return spark.createDataFrame(
        [(t, 0, i, None, k, v) for i, (t, k, v) in enumerate(rows)], BUS)


def _order(oid, t, user="u1"):
    return ("produceOrderInfo", oid, f"{user},{oid},addressId01,{t},10.00,10.00,0.00,20.00")


def _pay(oid, t, topic="producerOrderids"):
    return (topic, oid, f"{oid},card(0001),{t},3,type01")


ROWS = [
    _order("o1", "2019-09-01 12:00:00"), _pay("o1", "2019-09-01 12:03:00"),   # paid
    _order("o2", "2019-09-01 12:00:00"), _pay("o2", "2019-09-01 12:09:00"),   # late
    _order("o3", "2019-09-01 12:00:00"),                                      # remind
    _order("o4", "2019-09-01 12:55:00"),                                      # exactly 5 min
    _order("o5", "2019-09-01 12:10:00"), _pay("o5", "2019-09-01 12:08:00"),   # paid early
    _pay("x9", "2019-09-01 12:01:00"),                                        # orphan
    ("ProducerOrderids", "o3", "o3,card(0002),2019-09-01 12:01:00,1,type01"),  # wrong case
    _pay("o6", "2019-09-01 12:20:00", topic="pay2"), _order("o6", "2019-09-01 12:18:00"),
]
AS_OF = "2019-09-01 13:00:00"


def status(spark, rows, as_of=AS_OF, **kw):
    bus = _bus(spark, rows)
    st = orders.order_payment_status(orders.orders_from_bus(bus), orders.payments_from_bus(bus),
                                     as_of, **kw)
    return st, {r["orderid"]: r for r in st.collect()}


def test_status_rules(spark):
    st, got = status(spark, ROWS)
    assert {k: r["status"] for k, r in got.items()} == {
        "o1": "paid", "o2": "paid_late", "o3": "remind", "o4": "pending", "o5": "paid", "o6": "paid",
        "x9": "orphan"}
    assert status(spark, ROWS, pay_within=None)[1]["o2"]["status"] == "paid"
    carried = sorted(tuple(r) for r in orders.carry_forward(st).collect())
    assert carried == [("order2", "o4", "u1,o4,nothing,2019-09-01 12:55:00"),
                       ("pay2", "x9", "x9,card(0001),2019-09-01 12:01:00")]
    # a carried payment parses like a fresh one
    carried_pay = orders.carry_forward(st).where("topic = 'pay2'")
    reparsed = orders.payments_from_bus(carried_pay).first()
    assert (reparsed["payment"], reparsed["paymenttime"]) == ("card(0001)", "2019-09-01 12:01:00")


def test_one_row_per_order_with_several_payments_and_records(spark):
    rows = [_order("a", "2019-09-01 12:00:00"), _order("a", "2019-09-01 12:30:00", user="u2"),
            _pay("a", "2019-09-01 12:30:00"), _pay("a", "2019-09-01 12:01:00"),
            _order("b", "2019-09-01 12:00:00"), _pay("b", "2019-09-01 12:40:00"),
            _pay("b", "2019-09-01 12:20:00"), _pay("z", "2019-09-01 12:20:00"),
            _pay("z", "2019-09-01 12:10:00")]
    st, got = status(spark, rows)
    assert st.count() == 3
    assert (got["a"]["status"], got["a"]["paymenttime"]) == ("paid", "2019-09-01 12:01:00")
    assert got["a"]["ordertime"] == "2019-09-01 12:00:00"
    assert (got["b"]["status"], got["b"]["paymenttime"]) == ("paid_late", "2019-09-01 12:20:00")
    assert got["z"]["status"] == "orphan"


def test_untimed_records_are_kept(spark):
    rows = [_order("o2", "2019-09-01 12:00:00"), ("pay2", "o2", "o2,card"), _order("bad", "n/a"),
            _order("bad2", "n/a"), _pay("bad2", "2019-09-01 12:00:00"), ("pay2", "lost", "lost,card")]
    _, got = status(spark, rows)
    assert {k: r["status"] for k, r in got.items()} == {
        "o2": "paid_untimed", "bad": "untimed", "bad2": "untimed", "lost": "orphan"}
    _, got = status(spark, rows, pay_within=None)
    assert {k: r["status"] for k, r in got.items()} == {
        "o2": "paid", "bad": "untimed", "bad2": "paid", "lost": "orphan"}


def test_carried_records_are_consumed_in_the_next_round(spark):
    first, _ = status(spark, ROWS)
    carried = orders.carry_forward(first)
    later = _bus(spark, [_pay("o4", "2019-09-01 12:58:00"), _order("x9", "2019-09-01 12:00:00")])
    bus = carried.unionByName(later.select("topic", "key", "value"))
    st = orders.order_payment_status(orders.orders_from_bus(bus), orders.payments_from_bus(bus),
                                     "2019-09-01 14:00:00")
    assert {r["orderid"]: r["status"] for r in st.collect()} == {"o4": "paid", "x9": "paid"}


def at(hhmm):
    return dt.datetime.strptime(f"2019-09-01 {hhmm}", "%Y-%m-%d %H:%M")


def remind(spark, batches, restarts=False, **kw):
    """Run the reminder stream over (clock, rows) batches, in one run or with a
    restart before each."""
    root = work_dir(spark, "test", "verdicts", unique=True)
    folder = work_dir(spark, "test", "landing", unique=True)
    checkpoint = work_dir(spark, "test", "checkpoint", unique=True)
    clocks = [c for c, _ in batches]

    def run():
        bus_stream.finish(unpaid.start_unpaid_reminders(
            bus_stream.file_bus_stream(spark, folder, 1), root, checkpoint, trigger={"availableNow": True},
            clock=lambda df, i: clocks[i], **kw))
    for _, rows in batches:
        bus_stream.land_in_order([_bus(spark, rows)], folder)
        if restarts:
            run()
    if not restarts:
        run()
    return root


def changes(spark, root):
    return sorted((r["batch"], r["orderid"], r["verdict"]) for r in unpaid.reminder_state(spark, root).changes().collect())


def ids(spark, root, verdict=unpaid.REMIND):
    return sorted((r["batch"], r["orderid"]) for r in unpaid.verdicts(spark, root, verdict).collect())


def test_a_late_unpaid_order_is_reminded(spark):
    root = remind(spark, [
        (at("11:01"), [_order("o1", "2019-09-01 11:00:00")]),
        (at("11:05"), [_pay("o1", "2019-09-01 11:03:00")]),
        (at("11:10"), [_order("o2", "2019-09-01 10:30:00"), _order("o3", "2019-09-01 11:04:00")])])
    assert ids(spark, root) == [(2, "o2"), (2, "o3")]


def test_an_idle_payment_topic_does_not_hold_reminders_back(spark):
    root = remind(spark, [(at("10:01"), [_pay("p", "2019-09-01 10:01:00")])] + [
        (at(f"{h}:06"), [_order(f"o{h}", f"2019-09-01 {h}:00:00")]) for h in (10, 11, 12, 13)])
    assert ids(spark, root) == [(1, "o10"), (2, "o11"), (3, "o12"), (4, "o13")]


def test_open_orders_and_waiting_payments_cross_batches(spark):
    root = remind(spark, [
        (at("12:01"), [_order("a", "2019-09-01 12:00:00"), _order("b", "2019-09-01 12:00:00"),
                       _pay("c", "2019-09-01 12:00:00"), ("pay2", "d", "d,card")]),
        (at("12:04"), [_pay("a", "2019-09-01 12:03:00"), _order("c", "2019-09-01 12:02:00")]),
        (at("12:05"), [_order("d", "2019-09-01 12:01:00"), _order("far", "2999-01-01 00:00:00"),
                       _order("bad", "n/a")]),
        (at("12:06"), [_pay("e", "2019-09-01 12:06:00")]),
        (at("12:30"), [_pay("b", "2019-09-01 12:29:00")])], restarts=True)
    # exactly five minutes is not yet due; a payment after the reminder changes nothing
    assert ids(spark, root) == [(3, "b")]
    assert ids(spark, root, unpaid.REJECTED) == [(2, "bad"), (2, "far")]


def test_an_old_backlog_with_the_payment_one_batch_ahead(spark):
    root = remind(spark, [
        (at("12:00"), [_pay("old", "2019-07-01 10:03:00"), _pay("older", "2018-07-01 10:03:00")]),
        (at("12:01"), [_order("old", "2019-07-01 10:00:00"), _order("unpaid", "2019-07-01 10:00:00")]),
        (at("12:02"), [_order("older", "2018-07-01 10:00:00")])])
    assert ids(spark, root) == [(1, "unpaid")]


def test_second_payments_and_redelivered_orders_change_nothing(spark):
    a, b = _order("a", "2019-09-01 12:00:00"), _order("b", "2019-09-01 12:00:00")
    batches = [(at("12:01"), [a, _pay("a", "2019-09-01 12:00:00"), b, _order("bad", "n/a")]),
               (at("12:02"), [_pay("a", "2019-09-01 12:02:00"), a, b]),
               (at("12:06"), [a]),
               (at("12:07"), [_pay("b", "2019-09-01 12:06:30"), b, _order("bad", "n/a")]),
               (at("12:20"), [a, _pay("a", "2019-09-01 12:19:00"), b])]
    want = [(0, "a", "paid"), (0, "b", "open"), (0, "bad", "rejected"), (2, "b", "remind")]
    for every in (1, 2, 16):  # whether the state is in a base or in changes
        root = remind(spark, batches, compact_every=every, buckets=2)
        assert changes(spark, root) == want


def test_a_batch_writes_its_own_keys_only(spark):
    orders_ = [_order(f"o{i}", "2019-09-01 12:00:00") for i in range(200)]
    root = remind(spark, [(at("12:01"), orders_), (at("12:02"), [_pay("o7", "2019-09-01 12:02:00")]),
                          (at("12:03"), [_pay("late", "2019-09-01 12:03:00")])])
    assert [c for c in changes(spark, root) if c[0]] == [(1, "o7", "paid"), (2, "late", "waiting")]


def test_old_changes_can_be_removed(spark):
    batches = [(at("12:01"), [_order("a", "2019-09-01 12:00:00"), _order("r", "2019-09-01 11:00:00")])]
    batches += [(at(f"12:0{i}"), [_pay(f"p{i}", "2019-09-01 12:00:00")]) for i in range(2, 5)]
    batches += [(at("12:04"), [_order("p2", "2019-09-01 12:00:00"), _order("r", "2019-09-01 11:00:00")]),
                (at("12:05"), [_pay("a", "2019-09-01 12:05:00")]), (at("12:30"), [_pay("a", "2019-09-01 12:05:00")]),
                (at("12:40"), [_order("p4", "2019-09-01 12:00:00")])]
    root = remind(spark, batches, compact_every=2, trim=True)
    got = changes(spark, root)
    assert [c for c in got if c[2] == "remind"] == [(0, "r", "remind")]
    assert (4, "p2", "paid") not in got and (7, "p4", "paid") in got
    state = unpaid.reminder_state(spark, root, compact_every=2)
    newest = {r["orderid"]: r["verdict"] for r in state.newest(state.versions(8)).collect()}
    assert newest == {"a": "paid", "r": "remind", "p2": "paid", "p3": "waiting", "p4": "paid"}
    assert len(folders(spark, f"{root}/base")) == 2


def test_the_state_is_compacted_in_levels(spark):
    """A version is written once per level; the state reads the same at any batch."""
    for every, batches in ((1, 6), (2, 13)):
        state = unpaid.reminder_state(spark, work_dir(spark, "test", "state", unique=True), 2, every)
        newest = {}
        for n in range(batches):
            rows = [(f"k{n}", "u", "t", None, n, "open"), ("k0", "u", "t", None, n, f"v{n}")][n == 0:]
            for _ in range(2):  # a replay finds what the batch found
                versions = state.versions(n)
                got = {} if versions is None else {r["orderid"]: (r["batch"], r["verdict"])
                                                   for r in state.newest(versions).collect()}
                assert got == newest
                state.append(spark.createDataFrame(rows, unpaid.STATE), n)
                state.compact(n)
            newest |= {r[0]: (n, r[5]) for r in rows}
        last = batches // every * every - 1
        assert spark.read.parquet(f"{state.root}/base/asof={last}").count() == every + 1  # not the whole state
        assert len(state.bases(batches)[0]) <= 4


def test_parts_are_written_side_by_side_and_land_in_order(spark, monkeypatch):
    import threading
    both, real = threading.Barrier(2, timeout=30), bus_stream.land_bus

    def land(df, folder):
        both.wait()  # a part alone would wait for ever
        real(df, folder)
    monkeypatch.setattr(bus_stream, "land_bus", land)
    folder = work_dir(spark, "test", "landing", unique=True)
    for first in (0, 10):
        bus_stream.land_in_order([spark.range(n, n + 1) for n in range(first, first + 10)], folder)
    files = spark.read.format("binaryFile").load(folder).select("path", "modificationTime").collect()
    files.sort(key=lambda r: r["modificationTime"])
    assert [spark.read.parquet(r["path"]).first()[0] for r in files] == list(range(20))
    assert len({r["modificationTime"] for r in files}) == 20
    assert folders(spark, folder) == []


def test_the_clock_does_not_depend_on_the_drivers_zone(spark):
    bus = _bus(spark, [_order("a", "2019-09-01 08:00:00")])
    saved = os.environ.get("TZ")
    try:
        for zone in ("UTC", "Asia/Shanghai", "America/New_York"):
            os.environ["TZ"] = zone
            time.tzset()
            assert unpaid.judge_batch(bus, None, at("08:10")).first()["verdict"] == "remind"
            assert unpaid.judge_batch(bus, None, at("08:04")).first()["verdict"] == "open"
    finally:
        os.environ.pop("TZ") if saved is None else os.environ.__setitem__("TZ", saved)
        time.tzset()
    far = unpaid.wall_clock(bus, 0, "Asia/Shanghai") - unpaid.wall_clock(bus, 0, "UTC")
    assert abs(far - dt.timedelta(hours=8)) < dt.timedelta(minutes=1)


def test_three_rounds_through_the_bus(spark):
    """Pending orders and payments come back as records of the next batch."""
    root, folder = (work_dir(spark, "test", n, unique=True) for n in ("looped", "bus"))
    rounds = [(at("12:01"), [_order("a", "2019-09-01 12:00:00"), _order("b", "2019-09-01 12:00:00"),
                             _pay("c", "2019-09-01 12:01:00"), _order("old", "2019-09-01 11:00:00")]),
              (at("12:04"), [_order("c", "2019-09-01 12:03:00"), _pay("a", "2019-09-01 12:03:00"),
                             ("pay2", "x", "x,card")]),
              (at("12:07"), [_order("d", "2019-09-01 12:06:00")])]

    def sink(batch, epoch):
        for _ in range(2):  # a replay publishes nothing twice
            loopback.loopback_batch(batch, epoch, root, f"{folder}/sink" if epoch == 2 else f"{folder}/bus",
                                    clock=lambda df, i: rounds[i][0])
        if epoch < 2:
            bus_stream.land_bus(_bus(spark, rounds[epoch + 1][1]), f"{folder}/bus/new-{epoch + 1}")
    bus_stream.land_bus(_bus(spark, rounds[0][1]), f"{folder}/bus/new-0")
    bus_stream.finish(loopback.looped_stream(spark, f"{folder}/bus").writeStream.foreachBatch(sink).option(
        "checkpointLocation", work_dir(spark, "test", "checkpoint", unique=True)).start())
    got = sorted((r["batch"], r["orderid"], r["verdict"]) for r in loopback.judged_rows(spark, root).collect())
    assert got == [(0, "a", "open"), (0, "b", "open"), (0, "c", "waiting"), (0, "old", "remind"),
                   (1, "a", "paid"), (1, "b", "open"), (1, "c", "paid"), (1, "x", "waiting"),
                   (2, "b", "remind"), (2, "d", "open"), (2, "x", "waiting")]
    pending = spark.read.parquet(f"{folder}/sink/carried-2").collect()
    assert {(r["topic"], r["value"]) for r in pending} == {
        ("order2", "u1,d,nothing,2019-09-01 12:06:00"), ("pay2", "x,card,")} or \
        {(r["topic"], r["value"].rstrip(",")) for r in pending} == {
            ("order2", "u1,d,nothing,2019-09-01 12:06:00"), ("pay2", "x,card")}


def test_a_replayed_batch_replaces_its_rows(spark):
    root = work_dir(spark, "test", "verdicts", unique=True)
    rows = _bus(spark, [_order("a", "2019-09-01 12:00:00")])
    for _ in range(2):
        unpaid.remind_batch(rows, 0, root, clock=lambda df, i: at("12:30"))
    assert ids(spark, root) == [(0, "a")]


def test_foreach_batch_offsets(spark):
    bus = _bus(spark, ROWS).withColumn("timestamp", F.lit("2019-09-01 12:00:00").cast("timestamp_ntz"))
    path = work_dir(spark, "test", "history", unique=True)
    folder = work_dir(spark, "test", "landing", unique=True)

    def sink(df, i):
        for _ in range(2):  # a replay counts once
            stream_offsets.offset_history_append(df, i, path, group="g")
    bus_stream.land_in_order([bus.where("offset < 9"), bus.where("offset >= 9")], folder)
    bus_stream.finish(bus_stream.file_bus_stream(spark, folder, 1).writeStream.foreachBatch(sink).option(
        "checkpointLocation", work_dir(spark, "test", "checkpoint", unique=True)).trigger(availableNow=True).start())
    history = stream_offsets.read_history(spark, path)
    assert history.agg(F.sum("records")).first()[0] == len(ROWS)
    assert {r["batch_id"] for r in history.collect()} == {0, 1}
    # what the stream writes is what the lookup reads
    latest = offsets.offset_latest_lookup(history, "g", "2019-09-01 13:00:00")
    want = {r["topic"]: r["m"] + 1 for r in bus.groupBy("topic").agg(F.max("offset").alias("m")).collect()}
    assert {r["topic"]: r["offset"] for r in latest.collect()} == want
    assert offsets.offset_latest_lookup(history, "other").count() == 0
    # the newest batch alone knows every partition, also those it had nothing from
    newest = stream_offsets.newest_positions(spark, path, "g")
    assert {r["topic"]: r["until_offset"] for r in newest.collect()} == want
    assert sorted(r["records"] for r in newest.collect()) != [] and 0 in {r["records"] for r in newest.collect()}
    assert len(newest.inputFiles()) == 1
    assert stream_offsets.newest_positions(spark, path, "other").count() == 0


def test_record_parsers_tolerate_short_records(spark):
    df = spark.createDataFrame([("a,b",)], "value string")
    r = orders.order_record_parse(df).first()
    assert (r["userId"], r["orderid"], r["amount"]) == ("a", "b", None)
    d = orders.delivery_record_parse(spark.createDataFrame([("1,addressId02,addr,bob,139",)],
                                                           "value string")).first()
    assert d["linkman"] == "bob"


def test_aqe_splits_a_hot_orderid(spark):
    """The left-join form of the order/payment match lets AQE split a hot
    orderid on the orders side (a FULL OUTER JOIN could not be split)."""
    confs = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
             "spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    saved = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        o_rows = [("hot" if i < 20000 else f"o{i}", f"u{i}", "2019-09-01 12:00:00")
                  for i in range(30000)]
        o = spark.createDataFrame(o_rows, "orderid string, userid string, ordertime string")
        o = o.withColumn("order_ts", F.col("ordertime").cast("timestamp_ntz")).repartition(8)
        p_rows = [("hot", "card", "2019-09-01 12:01:00")] + [
            (f"o{i}", "card", "2019-09-01 12:01:00") for i in range(20000, 30000, 2)] + [
            ("x1", "card", "2019-09-01 12:01:00")]
        p = spark.createDataFrame(p_rows, "orderid string, payment string, paymenttime string")
        p = p.withColumn("pay_ts", F.col("paymenttime").cast("timestamp_ntz"))
        out = orders.orders_payments_full_outer(o, p)
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        assert len(rows) == 30000 + 1     # every order once, plus the orphan payment
        assert sum(1 for r in rows if r["has_payment"] and r["has_order"]) == 20000 + 5000
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _hot(spark):
    """One order id with a third of all payments, another with many order records."""
    o = [("hot", f"u{i}", f"t{i}") for i in range(3)] + [("wide", f"u{i}", f"w{i}") for i in range(3000)]
    o += [(f"o{i}", "u", "t") for i in range(4000)] + [(None, "u", "t"), ("hot", "u0", "t0")]
    p = [("hot", "card", f"p{i}") for i in range(4000)] + [("wide", "card", "x"), ("wide", "card", "x")]
    p += [(f"o{i}", "card", f"p{i}") for i in range(0, 8000, 2)] + [("lone", "card", f"p{i}") for i in range(2500)]
    p += [(None, "card", "n")]
    of = spark.createDataFrame(o, "orderid string, userid string, ordertime string").withColumn(
        "order_ts", F.lit(None).cast("timestamp_ntz")).repartition(8)
    pf = spark.createDataFrame(p, "orderid string, payment string, paymenttime string").withColumn(
        "pay_ts", F.lit(None).cast("timestamp_ntz")).repartition(8)
    return of, pf


def test_salted_join_gives_the_rows_of_the_full_outer_join(spark):
    o, p = _hot(spark)
    want = sorted(map(repr, orders.orders_payments_full_outer(o, p).collect()))
    assert len(want) > 17_000
    for hot in ({}, {"hot": 5}, {"hot": 3, "wide": 4, "lone": 2, "absent": 6}):
        assert sorted(map(repr, orders.orders_payments_salted(o, p, hot).collect())) == want
    assert sorted(map(repr, orders.orders_payments_salted(o, p, hot_rows=500).collect())) == want


def test_hot_keys_are_found_by_a_sample(spark):
    o, p = _hot(spark)
    assert set(orders.hot_keys(p, "orderid", 1000, share=0.5)) == {"hot", "lone"}
    assert orders.hot_keys(p, "orderid", 1000, share=0.5)["hot"] >= 4
    assert set(orders.hot_keys(o, "orderid", 1000, share=0.5)) == {"wide"}


def test_a_hot_order_leaves_no_straggler(spark):
    """No task of the join holds more than a few parts of a hot id."""
    o, p = _hot(spark)
    hot = orders.hot_keys(p, "orderid", 500, share=0.5) | orders.hot_keys(o, "orderid", 500, share=0.5)
    keep = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled",
                                                 "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        def largest(df):
            rows = df.where("has_order AND has_payment").groupBy(F.spark_partition_id().alias("t")).count()
            return rows.agg(F.max("count")).first()[0]
        plain = largest(orders.orders_payments_full_outer(o, p))
        salted = largest(orders.orders_payments_salted(o, p, hot))
    finally:
        for k, v in keep.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert plain >= 16_000 and salted < plain / 3


def test_bucketed_tables_join_without_a_shuffle(spark):
    from logloom.plans import catalog

    from .conftest import SF_SMALL
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = catalog.QUERIES["orders_payments_bucketed"](spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert df.count() == catalog.QUERIES["orders_payments_full_outer"](spark, SF_SMALL).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_buckets_follow_the_records(spark, monkeypatch):
    from logloom.plans import catalog
    from logloom.plans.inputs import Inputs

    from .conftest import SF_SMALL
    inp = Inputs(spark, SF_SMALL)
    for per_bucket, want in ((500, -(-inp.bus.count() // 500)), (500_000, catalog.BUCKETS)):
        monkeypatch.setattr(catalog, "BUCKET_RECORDS", per_bucket)
        name = catalog._tables(spark, inp)
        for table in ("orders", "payments"):
            found = spark.sql(f"DESCRIBE EXTENDED {name}.{table}").where("col_name = 'Num Buckets'").first()
            assert int(found["data_type"]) == want
        df = catalog.QUERIES["orders_payments_bucketed"](spark, SF_SMALL)
        assert df.count() == catalog.QUERIES["orders_payments_full_outer"](spark, SF_SMALL).count()
