"""PV / IP / UV fact marts and visit detection.

Grain names follow what the roll-ups read: the time key of every mart is
called ``timeid`` (``yyyyMMdd`` for days, ``yyyyMMddHH`` for hours).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.operators.star import DIM_IDS

GRAIN_CHARS = {"day": 8, "hour": 10, "minute": 12}
# visit gap per device id, in seconds: 1 -> 300 (PC), 2 -> 1800 (mobile);
# other devices only ever count their first request
DEFAULT_VISIT_GAPS = {1: 300, 2: 1800}


def _grain(grain: str) -> Column:
    return F.substring("timeid", 1, GRAIN_CHARS[grain]).alias("timeid")


def pv_mart(facts: DataFrame, grain: str = "day") -> DataFrame:
    """Page views by (time grain, district, referer, device, column).

    Partial aggregation on the map side turns the fact stream into at most
    one row per group per task before the shuffle, so hot groups cost no
    more to shuffle than cold ones.
    """
    return facts.groupBy(_grain(grain), *DIM_IDS).agg(F.count(F.lit(1)).alias("pv"))


def ip_mart(facts: DataFrame) -> DataFrame:
    """Distinct (day, ip, district, referer, device, column)."""
    return facts.select(_grain("day"), "ip", *DIM_IDS).distinct()


def _is_visit_gap(gap: Column, device: Column, gaps: dict[int, int]) -> Column:
    cond = F.lit(False)
    for dev, seconds in gaps.items():
        cond = cond | ((gap >= seconds) & (device == dev))
    return cond


def session_minutes(facts: DataFrame) -> DataFrame:
    """The first request of each (session, minute): sessionid, ts, ``f``.

    Inside one (session, minute) every request after the first has gap 0 and so
    never starts a visit (thresholds are positive).  Equal requests of a second
    are first collapsed by a hash aggregate on (session, minute, second, ids),
    which needs no sort and leaves far fewer rows for ``min(struct(second,
    ids))``; the sort then sees distinct rows only.  Both spread even a session
    that holds a third of all rows.
    """
    distinct = facts.select("sessionid", "ts", "daystr", *DIM_IDS, "timeid").distinct()
    return distinct.groupBy("sessionid", "ts").agg(F.min(F.struct("daystr", *DIM_IDS, "timeid")).alias("f"))


def last_requests(minutes: DataFrame, carry: DataFrame | None = None) -> DataFrame:
    """``sessionid, ts``: the last minute of every session in ``minutes`` or in
    an earlier such table."""
    rows = minutes.select("sessionid", "ts")
    if carry is not None:
        rows = rows.unionByName(carry.select("sessionid", "ts"))
    return rows.groupBy("sessionid").agg(F.max("ts").alias("ts"))


def starts_of_minutes(minutes: DataFrame, carry: DataFrame | None = None,
                      gaps: dict[int, int] | None = None) -> DataFrame:
    """Visit starts among the ``session_minutes`` of some days.

    ``carry`` holds the last request of each session before these days
    (``last_requests``); it stands as the predecessor of the session's first
    request, in the same window and the same shuffle.
    """
    gaps = DEFAULT_VISIT_GAPS if gaps is None else gaps
    if any(s <= 0 for s in gaps.values()):
        raise ValueError("visit gap thresholds must be positive")
    rows = minutes.select("sessionid", "ts", "f")
    if carry is not None:
        rows = rows.unionByName(carry.select("sessionid", "ts", F.lit(None).cast(
            rows.schema["f"].dataType).alias("f")))
    w = Window.partitionBy("sessionid").orderBy("ts")
    lagged = rows.withColumn("fts", F.lag("ts").over(w)).where(F.col("f").isNotNull())
    start = (F.col("fts").isNull()
             | _is_visit_gap(F.col("ts") - F.col("fts"), F.col("f.devicetypeid"), gaps))
    return lagged.where(start).select(
        "f.timeid", "ts", "sessionid", *[F.col(f"f.{c}").alias(c) for c in DIM_IDS])


def visit_starts(facts: DataFrame, gaps: dict[int, int] | None = None,
                 carry: DataFrame | None = None) -> DataFrame:
    """Requests that start a visit.

    Reference rule: order a session's requests by minute ``ts``; a request
    starts a visit when it has no predecessor, or the gap to the previous
    request reaches the device's threshold.  Ties inside a minute are
    ordered by the second-resolution ``daystr`` and then the dimension ids.

    Skew-proof plan: the facts are reduced to the first request of each
    (session, minute), and only those rows go through the ``lag`` window per
    session, where a session has at most one row per minute of the period,
    however much traffic it carries.  With ``carry``, the last request of each
    session before, the facts may be those of new days only.

    Input: timeid, ts, sessionid, ids, daystr.  Output: timeid, ts,
    sessionid, districtid, refererhostid, devicetypeid, columnid.
    """
    return starts_of_minutes(session_minutes(facts), carry, gaps)


def uv_mart(facts: DataFrame, gaps: dict[int, int] | None = None) -> DataFrame:
    """Visit starts by (day, session, district, referer, device, column).

    ``uv`` is the number of visit starts (the reference's definition), not a
    count of distinct visitors.
    """
    return uv_of_starts(visit_starts(facts, gaps))


def uv_of_starts(starts: DataFrame) -> DataFrame:
    """Visit starts counted by (day, session, ids)."""
    return (starts.groupBy(_grain("day"), "sessionid", *DIM_IDS)
            .agg(F.count(F.lit(1)).alias("uv")))
