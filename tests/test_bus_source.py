"""The kept bus as a stream: explicit start offsets, bounded batches, reports."""

import json

from pyspark.sql import functions as F

from logloom.operators import offsets, orders
from logloom.plans import jobs
from logloom.plans.inputs import Inputs
from logloom.session import work_dir
from logloom.sources import derived
from logloom.sources.bus_source import BusReader
from logloom.streaming import bus as bus_stream
from logloom.streaming import offsets as stream_offsets
from logloom.streaming import unpaid

from .conftest import SF_SMALL


def consume(spark, root, start="{}", step=300, topics=None, checkpoint=None):
    """Rows and, per batch, the offset ranges that a consumer read."""
    out = work_dir(spark, "test", "rows", unique=True)
    name = out.rsplit("/", 1)[-1]
    report = stream_offsets.BatchReport(spark, name, f"{out}-report")
    spark.streams.addListener(report)
    history, checkpoint = f"{out}-history", checkpoint or f"{out}-ckpt"

    def sink(batch, epoch):
        batch = batch.persist()
        batch.write.mode("overwrite").parquet(f"{out}/batch={epoch}")
        stream_offsets.offset_history_append(batch, epoch, history, "g")
        batch.unpersist()
    try:
        bus_stream.finish(bus_stream.kept_bus_stream(spark, root, start, checkpoint, step, topics).writeStream.queryName(name)
                          .foreachBatch(sink).option("checkpointLocation", checkpoint).start())
        report.wait(spark, history)
    finally:
        spark.streams.removeListener(report)
    return spark.read.parquet(out), report.rows(), stream_offsets.read_history(spark, history)


def keys(df):
    return sorted((r["topic"], r["partition"], r["offset"], r["key"], r["value"]) for r in df.collect())


def test_every_order_and_line_item_is_on_the_bus(spark):
    inp = Inputs(spark, SF_SMALL)
    o = orders.route_topics(inp.bus, orders.ORDER_TOPICS)
    p = orders.route_topics(inp.bus, orders.PAYMENT_TOPICS)
    assert o.select("key").distinct().count() == inp.table("orders").count()
    assert p.count() == inp.table("lineitem").count()
    # offsets count the records of a partition without gaps
    gaps = inp.bus.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("n"), F.min("offset").alias("lo"), F.max("offset").alias("hi"),
        F.countDistinct("offset").alias("d"))
    assert gaps.where("lo <> 0 OR hi <> n - 1 OR d <> n").count() == 0


def test_the_bus_is_dealt_once_when_it_is_numbered(spark):
    import re
    records = spark.createDataFrame([("t", k % 4, k % 7, None, "k", f"v{k}") for k in range(100)],
                                    "topic string, partition int, segment int, timestamp timestamp_ntz, key string, value string")
    counts = spark.createDataFrame([("t", p, n, 10 * n, 10 * n + 9) for p in range(4) for n in range(7)], derived.INDEX_SCHEMA)
    rows = derived.with_offsets(records, counts).sortWithinPartitions("segment", "topic", "partition", "offset")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"hashpartitioning\(([^)]*)\)", plan.split("Initial Plan")[-1]) == [
        m for m in re.findall(r"hashpartitioning\((segment#\d+, \d+)\)", plan.split("Initial Plan")[-1])][:1]
    assert rows.rdd.getNumPartitions() == 7  # as many parts as segments
    assert rows.count() == 100


def test_batches_are_bounded_and_reported_as_the_sink_counts(spark):
    inp = Inputs(spark, SF_SMALL)
    rows, report, history = consume(spark, inp.bus_root)
    assert keys(rows) == keys(inp.bus)
    got = report.collect()
    assert max(r["batch_id"] for r in got) >= 3
    assert all(0 <= r["until_offset"] - r["from_offset"] <= 300 for r in got)
    assert {r["batch_id"]: r["rows"] for r in got} == {
        r["batch_id"]: r["n"] for r in history.groupBy("batch_id").agg(F.sum("records").alias("n")).collect()}
    ranges = {(r["batch_id"], r["topic"], r["partition"]): (r["from_offset"], r["until_offset"]) for r in got}
    assert ranges == {(r["batch_id"], r["topic"], r["partition"]): (r["from_offset"], r["until_offset"])
                      for r in history.collect()}


def test_a_second_consumer_resumes_at_stored_positions(spark):
    inp = Inputs(spark, SF_SMALL)
    bounds = offsets.index_bounds(inp.bus_index)
    stored = bounds.select("topic", "partition", F.floor(F.col("latest") * 0.6).cast("bigint").alias("offset"))
    start = offsets.starting_offsets_json(offsets.starting_offsets_resolve(
        stored.where("topic <> 'pay2'"), bounds))
    rows, _, _ = consume(spark, inp.bus_root, start, step=100_000)
    at = {(t, int(p)): o for t, parts in json.loads(start).items() for p, o in parts.items()}
    assert all(o == 0 for (t, _), o in at.items() if t == "pay2")
    assert keys(rows) == [k for k in keys(inp.bus) if k[2] >= at[k[0], k[1]]]
    rows, _, _ = consume(spark, inp.bus_root, step=100_000, topics=["order2"])
    assert keys(rows) == [k for k in keys(inp.bus) if k[0] == "order2"]


def test_a_query_resumes_from_its_checkpoint(spark):
    inp = Inputs(spark, SF_SMALL)
    root, checkpoint = (work_dir(spark, "test", n, unique=True) for n in ("bus", "checkpoint"))
    early = F.col("segment") < 4
    for part, condition in (("a", early), ("b", ~early)):
        inp.bus_segments.where(condition).repartition("segment").write.mode("append").partitionBy(
            "segment").parquet(f"{root}/records")
        inp.bus_index.where(condition).write.mode("append").parquet(f"{root}/index")
        got, _, _ = consume(spark, root, checkpoint=checkpoint)
        assert keys(got) == keys(inp.bus_segments.where(condition).drop("segment"))


def test_reader_plans_ranges_by_segment(tmp_path, spark):
    spark.createDataFrame([("t", 0, 0, 0, 10), ("t", 0, 1, 10, 15), ("u", 1, 1, 0, 4)],
                          derived.INDEX_SCHEMA).write.parquet(f"{tmp_path}/index")
    options = {"path": str(tmp_path), "startingoffsets": '{"t": {"0": 7}}', "maxoffsetsperpartition": "5",
               "notes": f"{tmp_path}/notes"}
    reader = BusReader(options)
    second = reader.latestOffset()
    first = reader.initialOffset()
    assert first == {"t": {"0": 7}, "u": {"1": 0}} and second == {"t": {"0": 12}, "u": {"1": 4}}
    # started again, it goes on from the end it has handed out
    reader = BusReader(options)
    assert [(p.path.rsplit("=", 1)[1], p.ranges) for p in reader.partitions(first, second)] == [
        ("0", [("t", 0, 7, 10)]), ("1", [("t", 0, 10, 12), ("u", 1, 0, 4)])]
    assert reader.latestOffset() == {"t": {"0": 15}, "u": {"1": 4}} == reader.latestOffset()
    assert reader.partitions(reader.latestOffset(), reader.latestOffset()) == []


def test_reminder_job_stores_reports_and_resumes(spark):
    inp = Inputs(spark, SF_SMALL)
    out = work_dir(spark, "test", "job", unique=True)
    for run in range(2):  # a fresh checkpoint each time: the stored positions say where to go on
        jobs.reminders(spark, out, f"{out}/checkpoint-{run}", bus=inp.bus_root, once=True, clock=unpaid.bus_clock)
        assert stream_offsets.read_history(spark, f"{out}/offsets").agg(F.sum("records")).first()[0] == inp.bus.count()
    assert spark.read.schema(stream_offsets.REPORT).parquet(f"{out}/report").agg(
        F.max("rows")).first()[0] == inp.bus.count()
    ends = {(r["topic"], r["partition"]): r["latest"] for r in offsets.index_bounds(inp.bus_index).collect()}
    stored = json.loads(unpaid.stored_start(spark, out))
    assert {(t, int(p)): o for t, parts in stored.items() for p, o in parts.items()} == ends
    got = unpaid.verdicts(spark, out)
    assert got.count() == got.select("orderid").distinct().count() > 0
    assert unpaid.reminder_state(spark, out).changes().agg(F.max("batch")).first()[0] == 0  # the second read nothing new


def test_a_batch_of_the_history_takes_few_jobs(spark):
    sc, table = spark.sparkContext, work_dir(spark, "test", "history", unique=True)
    rows = [("t", p, o, None, "k", "v") for p in range(3) for o in range(50)]
    batch = spark.createDataFrame(rows, derived.BUS_SCHEMA)
    stream_offsets.offset_history_append(batch, 0, table, "g")
    sc.setJobGroup("history", "a batch")
    try:
        stream_offsets.offset_history_append(batch.where("partition < 2"), 1, table, "g")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("history")) <= 2  # an adaptive shuffle
    stream_offsets._STORED.clear()  # as after a restart
    for _ in range(2):
        stream_offsets.offset_history_append(batch.where("partition < 1"), 2, table, "g")
    got = sorted((r["batch_id"], r["partition"], r["from_offset"], r["until_offset"], r["records"])
                 for r in stream_offsets.read_history(spark, table).collect())
    assert got == [(0, 0, 0, 50, 50), (0, 1, 0, 50, 50), (0, 2, 0, 50, 50),
                   (1, 0, 0, 50, 50), (1, 1, 0, 50, 50), (1, 2, 50, 50, 0),
                   (2, 0, 0, 50, 50), (2, 1, 50, 50, 0), (2, 2, 50, 50, 0)]


def test_a_batch_is_planned_adaptively(spark):
    """Few rows are not dealt over every shuffle partition."""
    inp, seen = Inputs(spark, SF_SMALL), []
    history, checkpoint = (work_dir(spark, "test", n, unique=True) for n in ("history", "checkpoint"))

    def sink(batch, epoch):
        stream_offsets.offset_history_append(batch, epoch, history, "g")
        seen.append(stream_offsets.batch_offsets(batch, epoch).rdd.getNumPartitions())
    bus_stream.finish(bus_stream.kept_bus_stream(spark, inp.bus_root, "{}", checkpoint, 100_000).writeStream.foreachBatch(
        sink).option("checkpointLocation", checkpoint).start())
    assert seen and max(seen) < int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_the_index_is_read_again_only_when_it_has_changed(tmp_path, spark, monkeypatch):
    from logloom.sources import bus_source
    reads, real = [], bus_source._dataset
    monkeypatch.setattr(bus_source, "_dataset", lambda path, **kw: reads.append(path) or real(path, **kw))
    spark.createDataFrame([("t", 0, 0, 0, 10)], derived.INDEX_SCHEMA).write.parquet(f"{tmp_path}/index")
    reader = BusReader({"path": str(tmp_path)})
    assert [reader.latestOffset() for _ in range(3)] == [{"t": {"0": 10}}] * 3
    assert len(reader.partitions({"t": {"0": 2}}, {"t": {"0": 10}})) == 1
    assert len(reads) == 1
    spark.createDataFrame([("t", 0, 1, 10, 15)], derived.INDEX_SCHEMA).write.mode("append").parquet(f"{tmp_path}/index")
    assert reader.latestOffset() == {"t": {"0": 15}}
    assert [p.ranges for p in reader.partitions({"t": {"0": 10}}, {"t": {"0": 15}})] == [[("t", 0, 10, 15)]]
    assert len(reads) == 2


def test_a_batch_of_one_landed_file_is_read_by_several_tasks(spark):
    from pyspark.sql.functions import lit, uuid

    from logloom.session import SPLIT_SMALL_FILES, settings
    folder, checkpoint = (work_dir(spark, "test", n, unique=True) for n in ("bus", "checkpoint"))
    rows = spark.range(40_000).select(lit("t").alias("topic"), lit(0).alias("partition"), F.col("id").alias("offset"),
                                      lit(None).cast("timestamp_ntz").alias("timestamp"), uuid().alias("key"), uuid().alias("value"))
    bus_stream.land_in_order([rows], folder)
    seen = []
    with settings(spark, SPLIT_SMALL_FILES):
        bus_stream.finish(bus_stream.file_bus_stream(spark, folder, 1).writeStream.foreachBatch(
            lambda batch, epoch: seen.append(sum(n > 0 for n in batch.rdd.mapPartitions(
                lambda found: [sum(1 for _ in found)]).collect()))).option("checkpointLocation", checkpoint).start())
    assert len(seen) == 1 and seen[0] >= min(4, spark.sparkContext.defaultParallelism)


def test_the_positions_of_a_batch_are_counted_by_one_job(spark):
    sc, table = spark.sparkContext, work_dir(spark, "test", "history", unique=True)
    batch = spark.createDataFrame([("t", p, o, None, "k", "v") for p in range(3) for o in range(50)], derived.BUS_SCHEMA)
    sc.setJobGroup("positions", "a batch")
    try:
        stream_offsets.offset_history_append(batch, 0, table, "g")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("positions")) == 1  # two before: an adaptive shuffle
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true" and spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert stream_offsets.read_history(spark, table).agg(F.sum("records")).first()[0] == 150


def test_the_bus_is_kept_in_the_order_in_which_it_is_numbered(spark):
    inp = Inputs(spark, SF_SMALL)
    assert inp.bus_segments.count() > 0
    for path in inp.bus_segments.inputFiles():
        found = [(r["topic"], r["partition"], r["offset"]) for r in spark.read.parquet(path).collect()]
        assert found == sorted(found)
