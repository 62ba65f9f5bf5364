"""Row enrichment: site column, referer host, device class, date parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions import columns as C


def enrich_loginfo2(loginfo: DataFrame, fix_monitor_rule: bool = False) -> DataFrame:
    """loginfo -> loginfo2 (one projection, stays in whole-stage codegen).

    Output: ip, district, sessionid, datetime, daystr, columnName,
    refererHost, deviceType, year, month, day (ints from daystr).
    """
    y, m, d = C.split_ymd_int("daystr")
    return loginfo.select(
        "ip", "district", "sessionid", "datetime", "daystr",
        C.column_name("url").alias("columnName"),
        C.referer_host("referal").alias("refererHost"),
        C.device_type("userAgent", fix_monitor_rule).alias("deviceType"),
        y.alias("year"), m.alias("month"), d.alias("day"))


def device_type_lookup(df: DataFrame, dictionary: DataFrame, agent_col: str = "userAgent",
                       out_col: str = "devicetype") -> DataFrame:
    """Exact-match lookup of the agent in a given dictionary (``userAgent``,
    ``deviceType``); misses -> ``'unknown'``.

    The planner broadcasts a dictionary under its byte threshold and joins by
    shuffle beyond it; a repeated agent keeps its least device type, so that
    each input row stays one row.
    """
    lookup = dictionary.groupBy(F.col("userAgent").alias("_dict_agent")).agg(
        F.min("deviceType").alias("_dict_type"))
    joined = df.join(lookup, F.col(agent_col) == F.col("_dict_agent"), "left")
    return (joined.withColumn(out_col, F.coalesce("_dict_type", F.lit(C.DEVICE_UNKNOWN)))
            .drop("_dict_agent", "_dict_type"))


def enrich_newloginfo(loginfo: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Dictionary-device enrichment keeping url / referal / agent.

    Output: ip, district, sessionid, datetime, url, columnname, sentBytes
    (int; NULL when not a number), referal, referalhost, userAgent,
    devicetype, yearmonthday.
    """
    looked = device_type_lookup(loginfo, dictionary)
    return looked.select(
        "ip", "district", "sessionid", "datetime", "url",
        C.column_name("url").alias("columnname"),
        F.col("sentBytes").try_cast("int").alias("sentBytes"),
        "referal", C.referer_host("referal").alias("referalhost"),
        "userAgent", "devicetype", "yearmonthday")
