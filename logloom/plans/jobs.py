"""Runnable batch jobs with durable stage boundaries.

The reference runs its pipeline as separate applications joined by tables:
raw log -> ``loginfo`` -> ``loginfo2`` -> PV / UV / IP marts -> reports.
The same stages here, each reading the previous stage's Parquet table and
writing its own; a written table is also where lineage is cut, so a failed
later stage restarts from the last table instead of the raw log.

    python -m logloom.plans.jobs etl1  --log LOG --ranges RANGES --out DIR
    python -m logloom.plans.jobs etl2  --loginfo DIR --out DIR [--from 20240101 --to 20240102]
    python -m logloom.plans.jobs marts --loginfo2 DIR --dims DIR --out DIR [--from .. --to ..]
    python -m logloom.plans.jobs reports --marts DIR --dims DIR --out DIR
    python -m logloom.plans.jobs reminders --bootstrap HOST:PORT --out DIR --checkpoint DIR
    python -m logloom.plans.jobs calendar --start 2017-01-08 --days 2 --out DIR

With ``--from``/``--to`` (days, inclusive) only the partitions of those days
are read and rewritten; others stay.

Dimension tables are Parquet folders under ``--dims``: ``calendar``,
``columns``, ``devices``, ``districts``, ``referers`` with the columns of
:class:`logloom.sources.derived.Dimensions`.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom import schemas
from logloom.operators import geo, marts, reports
from logloom.operators.dims import time_dimension
from logloom.operators.enrich import enrich_loginfo2
from logloom.operators.star import star_join_ip, star_join_pv, star_join_uv
from logloom.plans import etl
from logloom.session import folders, remove, work_dir
from logloom.sources.derived import Dimensions
from logloom.sources.text import ip_ranges_load, log_text_scan
from logloom.streaming import unpaid
from logloom.streaming.bus import finish, kept_bus_stream

DIM_NAMES = ["calendar", "columns", "devices", "districts", "referers"]
MART_NAMES = ["pv_day", "pv_hour", "uv_day", "ip_day"]


def etl1(spark: SparkSession, log_path: str, ranges_path: str, out_path: str) -> None:
    """Raw access log + IP-range file -> ``loginfo`` (partitioned y/m/d)."""
    lookup = geo.bucketed_ranges(ip_ranges_load(spark, ranges_path))
    loginfo = etl.loginfo(log_text_scan(spark, log_path), lookup=lookup)
    etl.write_partitioned_overwrite(loginfo, out_path)


def _days(df: DataFrame, first: str | None, last: str | None) -> DataFrame:
    """Rows of the days ``first`` to ``last`` (``yyyyMMdd``): a predicate on
    the partition columns, so other days' folders are not read."""
    day = (F.col("year").cast("int") * 10000 + F.col("month").cast("int") * 100
           + F.col("day").cast("int"))
    if first:
        df = df.where(day >= int(first))
    if last:
        df = df.where(day <= int(last))
    return df


def etl2(spark: SparkSession, loginfo_path: str, out_path: str, first: str | None = None,
         last: str | None = None) -> None:
    """``loginfo`` -> ``loginfo2`` (partitioned by integer y/m/d)."""
    loginfo = _days(spark.read.schema(schemas.LOGINFO).parquet(loginfo_path), first, last)
    etl.write_partitioned_overwrite(enrich_loginfo2(loginfo), out_path)


def write_dimensions(dims: Dimensions, out_root: str) -> None:
    for name in DIM_NAMES:
        getattr(dims, name).write.mode("overwrite").parquet(f"{out_root}/{name}")


def read_dimensions(spark: SparkSession, root: str) -> Dimensions:
    return Dimensions(*(spark.read.parquet(f"{root}/{n}") for n in DIM_NAMES))


def _write_mart(mart: DataFrame, path: str) -> None:
    by_day = mart.withColumn("day", F.substring("timeid", 1, 8))
    etl.write_partitioned_overwrite(by_day, path, ["day"])


def read_mart(spark: SparkSession, marts_root: str, name: str) -> DataFrame:
    return spark.read.schema(schemas.MARTS[name]).parquet(f"{marts_root}/{name}").drop("day")


def build_marts(spark: SparkSession, loginfo2: DataFrame, dims: Dimensions, out_root: str,
                first: str | None = None, last: str | None = None) -> None:
    """``loginfo2`` + dimensions -> the four marts, partitioned by day.

    The daily PV mart is rolled up from the written hourly one (counts are
    additive), so the star join runs once for PV.  A day range limits what is
    read to its days, for the UV mart to those that ``build_uv`` needs.
    """
    some = _days(loginfo2, first, last)
    _write_mart(marts.pv_mart(star_join_pv(some, dims), "hour"), f"{out_root}/pv_hour")
    hour = spark.read.schema(schemas.MARTS["pv_hour"]).parquet(f"{out_root}/pv_hour")
    for bound, keep in ((first, lambda c, d: c >= d), (last, lambda c, d: c <= d)):
        if bound:
            hour = hour.where(keep(F.col("day"), F.lit(bound)))
    _write_mart(hour.groupBy(F.substring("timeid", 1, 8).alias("timeid"), *marts.DIM_IDS)
                .agg(F.sum("pv").alias("pv")), f"{out_root}/pv_day")
    build_uv(spark, loginfo2, dims, out_root, first, last)
    _write_mart(marts.ip_mart(star_join_ip(some, dims)), f"{out_root}/ip_day")


def uv_range(asofs: list[str], first: str | None, last: str | None) -> tuple[str | None, str | None]:
    """The carry to start from and the last day to compute.  Days between the
    carry and ``first`` are computed too, and so are days after ``last`` that
    were computed before, as their visits may depend on the changed ones."""
    before = max((a for a in asofs if first and a < first), default=None)
    after = max(asofs, default=None)
    return before, max(last, after) if last and after else last


def build_uv(spark: SparkSession, loginfo2: DataFrame, dims: Dimensions, out_root: str,
             first: str | None = None, last: str | None = None) -> None:
    """The UV mart of a day range, without the history before it.

    Whether a request starts a visit depends on the session's request before.
    The last request of every session up to a day is kept as
    ``visits/asof=<day>``, a row per session; a run reads the newest such table
    before its range and the facts of its own days, and leaves one as of its
    last day.
    """
    root = f"{out_root}/visits"
    asofs = [n.removeprefix("asof=") for n in folders(spark, root, complete=True) if n.startswith("asof=")]
    before, last = uv_range(asofs, first, last)
    days = _days(loginfo2, None, last)
    if before:
        days = _days(days, str(int(before) + 1), None)
    path = work_dir(spark, "tables", "session_minutes", unique=True)
    marts.session_minutes(star_join_uv(days, dims, with_tiebreak=True)).write.parquet(path)
    minutes = spark.read.schema(schemas.SESSION_MINUTES).parquet(path)
    carry = spark.read.schema(schemas.LAST_REQUESTS).parquet(f"{root}/asof={before}") if before else None
    _write_mart(marts.uv_of_starts(marts.starts_of_minutes(minutes, carry)), f"{out_root}/uv_day")
    newest = minutes.agg(F.max(F.substring("f.timeid", 1, 8))).first()[0]
    if newest:
        marts.last_requests(minutes, carry).write.mode("overwrite").parquet(f"{root}/asof={last or newest}")
    remove(spark, path)


def mart_reports(spark: SparkSession, marts_root: str, dims: Dimensions) -> dict[str, DataFrame]:
    """Every roll-up and top-3 report over written marts (lazy DataFrames)."""
    m = {n: read_mart(spark, marts_root, n) for n in MART_NAMES}
    out: dict[str, DataFrame] = {}
    for dim in ("device", "column", "referer", "district"):
        d = reports.dimension_for(dims, dim)
        out[f"pv_day_by_{dim}"] = reports.rollup_by(m["pv_day"], d, dim, "pv", "pv")
        out[f"pv_hour_by_{dim}"] = reports.rollup_by(m["pv_hour"], d, dim, "pv", "pv")
        out[f"uv_day_by_{dim}"] = reports.rollup_by(m["uv_day"], d, dim, "uv", "uv")
        out[f"ip_day_by_{dim}"] = reports.rollup_by(m["ip_day"], d, dim, None, "ips")
    out["ip_day_total"] = reports.ip_day_total(m["ip_day"])
    out["ip_day_total_exact"] = reports.ip_day_total(m["ip_day"], exact=True)
    for mart, measure, key in (("pv_day", "pv", "top3_columns_pv_day"),
                               ("pv_hour", "pv", "top3_columns_pv_hour"),
                               ("uv_day", "uv", "top3_columns_uv_day")):
        by_col = out[f"{mart}_by_column"]
        out[key] = reports.top_n(by_col, "timeid", measure, 3, ["columnName"])
    return out


def reminders(spark: SparkSession, out: str, checkpoint: str, bootstrap: str | None = None,
              bus: str | None = None, group: str = "reminders", starting_offsets: str | None = None,
              zone: str | None = None, once: bool = False, **kw) -> None:
    """The reminder job: verdicts, stored positions and batch reports under
    ``out``.  It goes on where its stored positions say, also with a fresh
    checkpoint folder."""
    kw = {"clock": lambda batch, epoch: unpaid.wall_clock(batch, epoch, zone)} | kw
    if bus:
        start = starting_offsets or unpaid.stored_start(spark, out, group) or "{}"
        query, _ = unpaid.start_reminder_job(
            kept_bus_stream(spark, bus, start, checkpoint), out, checkpoint, group, **kw)
    else:
        query, _ = unpaid.start_unpaid_reminders_kafka(spark, bootstrap, out, checkpoint, starting_offsets,
                                                       group=group, **kw)
    if once:
        finish(query)
    else:
        query.awaitTermination()


def main(argv: list[str] | None = None) -> None:
    from logloom.session import get_spark
    ap = argparse.ArgumentParser(prog="logloom.plans.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    a = sub.add_parser("etl1")
    a.add_argument("--log", required=True)
    a.add_argument("--ranges", required=True)
    a.add_argument("--out", required=True)
    b = sub.add_parser("etl2")
    b.add_argument("--loginfo", required=True)
    c = sub.add_parser("marts")
    c.add_argument("--loginfo2", required=True)
    r = sub.add_parser("reports")
    r.add_argument("--marts", required=True)
    for p in (b, c, r):
        p.add_argument("--out", required=True)
    for p in (b, c):
        p.add_argument("--from", dest="first")
        p.add_argument("--to", dest="last")
    for p in (c, r):
        p.add_argument("--dims", required=True)
    m = sub.add_parser("reminders")
    source = m.add_mutually_exclusive_group(required=True)
    source.add_argument("--bootstrap", help="Kafka brokers")
    source.add_argument("--bus", help="folder of a kept bus")
    m.add_argument("--out", required=True)
    m.add_argument("--checkpoint", required=True)
    m.add_argument("--group", default="reminders")
    m.add_argument("--starting-offsets", help="JSON; default: the positions stored by the job")
    m.add_argument("--zone", help="time zone of the order times, such as Asia/Shanghai")
    m.add_argument("--once", action="store_true", help="read what there is, then end")
    d = sub.add_parser("calendar")
    d.add_argument("--start", required=True)
    d.add_argument("--days", type=int, required=True)
    d.add_argument("--out", required=True)
    args = ap.parse_args(argv)
    spark = get_spark()
    if args.job == "etl1":
        etl1(spark, args.log, args.ranges, args.out)
    elif args.job == "etl2":
        etl2(spark, args.loginfo, args.out, args.first, args.last)
    elif args.job == "marts":
        build_marts(spark, spark.read.schema(schemas.LOGINFO2).parquet(args.loginfo2),
                    read_dimensions(spark, args.dims), args.out, args.first, args.last)
    elif args.job == "reports":
        for name, df in mart_reports(spark, args.marts, read_dimensions(spark, args.dims)).items():
            df.write.mode("overwrite").parquet(f"{args.out}/{name}")
    elif args.job == "reminders":
        reminders(spark, args.out, args.checkpoint, args.bootstrap, args.bus, args.group,
                  args.starting_offsets, args.zone, args.once)
    else:
        time_dimension(spark, args.start, args.days).write.mode("overwrite").parquet(args.out)


if __name__ == "__main__":
    main()
