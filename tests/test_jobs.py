"""End-to-end jobs over written stage tables agree with the lazy queries."""

import re

from logloom import schemas
from logloom.operators.dims import time_dimension_of
from logloom.plans import etl, jobs
from logloom.plans.catalog import QUERIES
from logloom.plans.inputs import Inputs
from logloom.session import folders, work_dir
from logloom.sources import derived

from .conftest import SF_SMALL


def _same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    cols = sorted(a.columns)
    assert sorted(map(tuple, a.select(cols).collect())) == \
        sorted(map(tuple, b.select(cols).collect()))


def test_jobs_end_to_end(spark):
    inp = Inputs(spark, SF_SMALL)
    root = work_dir(spark, "test", "jobs", unique=True)
    inp.lines.write.mode("overwrite").text(f"{root}/raw/access_log")
    inp.range_lines.coalesce(1).write.mode("overwrite").text(f"{root}/raw/ipaddress")
    jobs.write_dimensions(derived.dimensions(spark, inp.nation, time_dimension_of(inp.events)), f"{root}/dims")

    jobs.etl1(spark, f"{root}/raw/access_log", f"{root}/raw/ipaddress", f"{root}/loginfo")
    jobs.etl2(spark, f"{root}/loginfo", f"{root}/loginfo2")
    dims = jobs.read_dimensions(spark, f"{root}/dims")
    def l2():
        return spark.read.schema(schemas.LOGINFO2).parquet(f"{root}/loginfo2")
    jobs.build_marts(spark, l2(), dims, f"{root}/marts")
    # a second run over two days rewrites these days only, with the same rows
    jobs.etl2(spark, f"{root}/loginfo", f"{root}/loginfo2", "20240103", "20240104")
    jobs.build_marts(spark, l2(), dims, f"{root}/marts", "20240103", "20240104")

    for name, query in (("pv_day", "pv_mart_day"), ("pv_hour", "pv_mart_hour"),
                        ("uv_day", "uv_mart_day"), ("ip_day", "ip_mart_day")):
        _same(jobs.read_mart(spark, f"{root}/marts", name), QUERIES[query](spark, SF_SMALL))
    some = jobs._days(l2(), "20240103", "20240104")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]", plan)
    reps = jobs.mart_reports(spark, f"{root}/marts", dims)
    for name in ("pv_day_by_district", "uv_day_by_column", "ip_day_by_referer",
                 "ip_day_total", "top3_columns_pv_hour", "top3_columns_uv_day"):
        _same(reps[name], QUERIES[name](spark, SF_SMALL))


def test_uv_mart_day_by_day_equals_the_full_run(spark):
    inp = Inputs(spark, SF_SMALL)
    stage, root = (work_dir(spark, "test", n, unique=True) for n in ("loginfo2", "uv"))
    etl.write_partitioned_overwrite(inp.loginfo2, stage)
    l2 = spark.read.schema(schemas.LOGINFO2).parquet(stage)
    days = sorted(f"{r[0]:04d}{r[1]:02d}{r[2]:02d}" for r in l2.select("year", "month", "day").distinct().collect())
    jobs.build_uv(spark, l2, inp.dims, root, last=days[1])
    for day in days[2:]:
        jobs.build_uv(spark, l2, inp.dims, root, day, day)
    full = QUERIES["uv_mart_day"](spark, SF_SMALL)
    _same(jobs.read_mart(spark, root, "uv_day"), full)
    assert sorted(folders(spark, f"{root}/visits")) == [f"asof={d}" for d in days[1:]]
    # a day that is run again takes the days behind it along
    jobs.build_uv(spark, l2, inp.dims, root, days[3], days[3])
    _same(jobs.read_mart(spark, root, "uv_day"), full)
    # a run whose days before were never run computes these too
    other = work_dir(spark, "test", "uv", unique=True)
    jobs.build_uv(spark, l2, inp.dims, other, last=days[0])
    jobs.build_uv(spark, l2, inp.dims, other, days[-1], days[-1])
    _same(jobs.read_mart(spark, other, "uv_day"), full)


def test_uv_range():
    assert jobs.uv_range([], "20240105", "20240105") == (None, "20240105")
    assert jobs.uv_range(["20240104"], "20240105", "20240105") == ("20240104", "20240105")
    assert jobs.uv_range(["20240101", "20240110"], "20240105", "20240106") == ("20240101", "20240110")
    assert jobs.uv_range(["20240110"], None, None) == (None, None)


def test_reports_read_written_marts(spark):
    df = QUERIES["pv_day_by_district"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan and "sessionid" not in plan
    jobs.main(["calendar", "--start", "2017-01-08", "--days", "1",
               "--out", work_dir(spark, "test", "calendar", unique=True)])


def test_calendar_job(spark):
    out = work_dir(spark, "test", "calendar", unique=True)
    jobs.main(["calendar", "--start", "2017-01-08", "--days", "2", "--out", out])
    assert spark.read.parquet(out).count() == 2880
