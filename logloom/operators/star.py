"""Star join of loginfo2 facts to the five dimensions.

All five joins are INNER equi-joins, as in the reference: a fact missing
any dimension is dropped, a duplicated dimension key fans the fact out.
The dimensions are of known size (literal rows, ``spark.range`` calendars,
the nation table), so the planner broadcasts those under its byte threshold
from its own statistics and the facts stream through hash lookups inside one
stage -- no shuffle of the fact table.  No broadcast is forced: a dimension
that outgrows the threshold is joined by shuffle, where AQE splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIM_IDS = ["districtid", "refererhostid", "devicetypeid", "columnid"]


def star_join(loginfo2: DataFrame, dims, keep: list[str] | None = None) -> DataFrame:
    """Facts -> (timeid, districtid, refererhostid, devicetypeid, columnid, *keep)."""
    keep = keep or []
    f = loginfo2.select(
        F.substring("daystr", 1, 12).alias("_minute"), "columnName", "deviceType",
        "district", "refererHost", *[c for c in keep if c not in ("timeid",)])
    cal = dims.calendar.select("timeid")
    col = dims.columns.select(F.col("keyword").alias("_kw"), "columnid")
    dev = dims.devices.select(F.col("deviceTypeName").alias("_dev"), "devicetypeid")
    dis = dims.districts.select(F.col("districtName").alias("_dis"), "districtid")
    ref = dims.referers.select(F.col("url").alias("_ref"),
                               F.col("refererHostId").alias("refererhostid"))
    j = (f.join(cal, f["_minute"] == cal["timeid"])
         .join(col, F.col("columnName") == col["_kw"])
         .join(dev, F.col("deviceType") == dev["_dev"])
         .join(dis, F.col("district") == dis["_dis"])
         .join(ref, F.col("refererHost") == ref["_ref"]))
    return j.select("timeid", *DIM_IDS, *[c for c in keep if c != "timeid"])


def star_join_pv(loginfo2: DataFrame, dims) -> DataFrame:
    return star_join(loginfo2, dims)


def star_join_ip(loginfo2: DataFrame, dims) -> DataFrame:
    j = star_join(loginfo2, dims, keep=["ip"])
    return j.select("timeid", "ip", *DIM_IDS)


def minute_epoch(timeid_col: str = "timeid"):
    """``yyyyMMddHHmm`` -> seconds since 1970-01-01 00:00 (wall clock, so the
    value does not depend on the session time zone)."""
    return F.timestamp_diff(
        "SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
        F.to_timestamp_ntz(F.col(timeid_col), F.lit("yyyyMMddHHmm")))


def star_join_uv(loginfo2: DataFrame, dims, with_tiebreak: bool = False) -> DataFrame:
    """Facts with ``sessionid`` and minute ``ts``; ``daystr`` (seconds) is
    kept on request as the deterministic tie-breaker of visit ordering."""
    keep = ["sessionid"] + (["daystr"] if with_tiebreak else [])
    j = star_join(loginfo2, dims, keep=keep)
    cols = ["timeid", minute_epoch().alias("ts"), "sessionid", *DIM_IDS]
    return j.select(*cols, *(["daystr"] if with_tiebreak else []))
