"""ETL stages, writers, dimensions and the star join."""

import os

from pyspark.sql import functions as F

from logloom import schemas
from logloom.operators import dims as D
from logloom.operators.star import star_join_uv
from logloom.plans import etl
from logloom.plans.inputs import Inputs
from logloom.session import work_dir
from logloom.sources import derived
from logloom.sources.text import table_scan

from .conftest import SF_SMALL


def test_time_dimension_two_days(spark):
    cal = D.time_dimension(spark, "2017-01-08", 2)
    assert cal.count() == 2880
    ids = [r["timeid"] for r in cal.orderBy("timeid").select("timeid").collect()]
    assert ids[0] == "201701080000" and ids[-1] == "201701092359"
    row = cal.where("timeid = '201701081237'").first()
    assert (row["year"], row["month"], row["day"], row["hour"], row["minute"]) == \
        ("2017", "01", "08", "12", "37")


def test_time_dimension_of_the_days_of_events(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    cal = D.time_dimension_of(ev)
    days = ev.select(F.to_date("ts").alias("d")).distinct().count()
    assert cal.count() == cal.distinct().count() == days * 1440
    lo = ev.agg(F.min(F.to_date("ts"))).first()[0].isoformat()
    same = D.time_dimension(spark, lo, 1)
    assert sorted(cal.where(F.col("timeid").startswith(lo.replace("-", ""))).collect()) == sorted(same.collect())


def test_dynamic_partition_overwrite_keeps_other_partitions(spark):
    path = work_dir(spark, "test", "dyn", unique=True)
    base = spark.createDataFrame(
        [("a", "2024", "01", "01"), ("b", "2024", "01", "02")], "v string, year string, "
        "month string, day string")
    etl.write_partitioned_overwrite(base, path)
    update = spark.createDataFrame([("c", "2024", "01", "02")], base.schema)
    etl.write_partitioned_overwrite(update, path)
    got = sorted(tuple(r) for r in spark.read.schema(base.schema).parquet(path).collect())
    assert got == [("a", "2024", "01", "01"), ("c", "2024", "01", "02")]
    assert os.path.isdir(os.path.join(path.removeprefix("file:"), "year=2024/month=01/day=01"))


def test_loginfo_roundtrip_and_pruned_scan(spark):
    inp = Inputs(spark, SF_SMALL)
    path = work_dir(spark, "test", "loginfo", unique=True)
    etl.write_partitioned_overwrite(inp.loginfo, path)
    back = spark.read.schema(schemas.LOGINFO).parquet(path)
    assert back.count() == inp.loginfo.count()
    scan = table_scan(spark, path, ["ip", "daystr"], where="day = '03'", schema=schemas.LOGINFO)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "ReadSchema: struct<ip:string,daystr:string>" in plan
    assert scan.count() == inp.loginfo.where("day = '03'").count()


def test_star_join_drops_unmatched_and_fans_out_duplicates(spark):
    inp = Inputs(spark, SF_SMALL)
    facts = star_join_uv(inp.loginfo2, inp.dims, with_tiebreak=True)
    # 'signup' has two column rows: its facts appear twice
    l2 = inp.loginfo2
    matched = (l2.where(F.col("district").startswith("NATION"))
               .where(F.col("refererHost").isin("host1.example.com", "host2.example.com",
                                                "host3.example.com"))
               .where(F.col("columnName").isin("view", "click", "purchase", "signup")))
    expected = matched.select(F.when(F.col("columnName") == "signup", 2).otherwise(1)
                              .alias("n")).agg(F.sum("n")).first()[0]
    assert facts.count() == expected


def test_facts_of_two_years_are_all_kept(spark):
    """The calendar follows the data: nothing outside a fixed month is lost."""
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    both = ev.unionByName(ev.withColumn("ts", F.col("ts") + F.expr("INTERVAL 400 DAYS")))
    inp, two = Inputs(spark, SF_SMALL), Inputs(spark, SF_SMALL)
    two.__dict__.update(events=both, lines=derived.access_log_lines(both), dims=derived.dimensions(
        spark, inp.nation, D.time_dimension_of(both)))
    assert two.facts_pv.count() == 2 * inp.facts_pv.count() > 0


def test_a_far_timestamp_adds_one_day(spark):
    df = spark.createDataFrame([("2024-01-01",), ("9999-12-31",), (None,), ("2024-01-01",)], "d string").select(
        F.col("d").cast("timestamp").alias("ts"))
    got = D.time_dimension_of(df).groupBy(F.substring("timeid", 1, 8).alias("d")).count().collect()
    assert {r["d"]: r["count"] for r in got} == {"20240101": 1440, "99991231": 1440}
    assert D.time_dimension_of(df.limit(0)).count() == 0
    # and no other fact is lost
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    far = ev.unionByName(ev.limit(1).withColumn("ts", F.lit("9999-01-01 10:00:00").cast(ev.schema["ts"].dataType)))
    inp, wide = Inputs(spark, SF_SMALL), Inputs(spark, SF_SMALL)
    wide.__dict__.update(events=far, lines=derived.access_log_lines(far), dims=derived.dimensions(
        spark, inp.nation, D.time_dimension_of(far)))
    assert 0 <= wide.facts_pv.count() - inp.facts_pv.count() <= 2


def test_dictionary_disagrees_with_the_rules(spark):
    q = Inputs(spark, SF_SMALL)
    from logloom.functions import columns as C
    from logloom.operators.enrich import device_type_lookup
    looked = device_type_lookup(q.parsed, derived.agent_dictionary(spark))
    assert looked.count() == q.parsed.count()
    by_rule = looked.withColumn("rule", C.device_type("userAgent"))
    assert by_rule.where("devicetype <> rule").count() > 0
    assert by_rule.where("devicetype = 'unknown' AND userAgent LIKE 'DNSPod%'").count() > 0
    plan = looked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1  # one pass over the log


def test_star_join_plan_broadcasts_dimensions(spark):
    inp = Inputs(spark, SF_SMALL)
    df = inp.facts_pv
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("BroadcastHashJoin") >= 6   # 5 dimensions + IP lookup


def test_derived_lines_contain_edge_rows(spark):
    inp = Inputs(spark, SF_SMALL)
    lines = inp.lines
    assert lines.where(F.col("value").startswith("garbage")).count() > 0
    parsed = inp.parsed
    assert parsed.where(F.col("url") == "GET / HTTP/1.1").count() > 0
    assert parsed.where(F.col("status").isin("404", "500")).count() > 0
    assert derived.ip_range_lines(inp.nation, inp.region).count() == 45


def test_catalog_table_insert_overwrite_and_scan(spark):
    inp = Inputs(spark, SF_SMALL)
    loc = work_dir(spark, "test", "catalog_loginfo", unique=True)
    name = "loginfo_" + os.path.basename(loc)
    cols = ", ".join(f"{c} string" for c in etl.LOGINFO_COLUMNS)
    spark.sql(f"CREATE TABLE {name} ({cols}, year string, month string, day string) "
              f"USING parquet PARTITIONED BY (year, month, day) LOCATION '{loc}'")
    try:
        etl.insert_overwrite_table(inp.loginfo, name)
        first = inp.loginfo.where("day = '03'")
        etl.insert_overwrite_table(first.limit(1), name)   # replaces day 03 only
        got = table_scan(spark, name, ["ip", "day"])
        assert got.where("day = '03'").count() == 1
        assert got.where("day <> '03'").count() == inp.loginfo.where("day <> '03'").count()
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
