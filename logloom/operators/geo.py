"""IP -> district range lookup.

Semantics (the sorted-array search of the reference, made total): of the
ranges that contain the ip the one with the greatest start wins, i.e. the
innermost of nested ranges; no range contains it: ``'unknown'``.  Among
ranges with equal starts the one with the least end (then greatest district)
is the innermost.

Plan: the range table -- bounded by the IP space -- is cut into the /16
buckets that each range overlaps, and within a bucket into *disjoint
segments* between range edges, each with its winning range.  Facts are joined
on the bucket (an equi-key, so no nested loop) plus the BETWEEN refinement.
At most one segment matches, so a LEFT join keeps exactly one row per log
line with no post-join aggregation or shuffle of the facts.  The planner
broadcasts the segments under its byte threshold; otherwise both sides
shuffle on the bucket and AQE splits a hot bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logloom.functions.columns import UNKNOWN_DISTRICT, ipv4_to_long

BUCKET_BITS = 16
IP_MAX = (1 << 32) - 1


def bucketed_ranges(ranges: DataFrame) -> DataFrame:
    """(start_ip, end_ip, district) -> disjoint segments per /16 bucket.

    Output: rng_bucket, eff_start, eff_end, rng_district.  Ranges outside the
    IP space, or with their start above their end, are left out, so a range
    explodes to 65,536 buckets at most.
    """
    r = ranges.where((F.col("start_ip") >= 0) & (F.col("end_ip") <= IP_MAX)
                     & (F.col("start_ip") <= F.col("end_ip")))
    size = 1 << BUCKET_BITS
    cut = r.select(F.explode(F.sequence(F.shiftright("start_ip", BUCKET_BITS),
                                        F.shiftright("end_ip", BUCKET_BITS))).alias("rng_bucket"),
                   "start_ip", "end_ip", "district")
    low, high = F.col("rng_bucket") * size, F.col("rng_bucket") * size + (size - 1)
    # of ranges that cover one stretch of a bucket only the innermost matters
    cut = (cut.select("rng_bucket", F.greatest("start_ip", low).alias("s"),
                      F.least("end_ip", high).alias("e"), "start_ip", "end_ip", "district")
           .groupBy("rng_bucket", "s", "e")
           .agg(F.max(F.struct("start_ip", (-F.col("end_ip")).alias("inner"), "district")).alias("w")))
    edges = (cut.select("rng_bucket", F.explode(F.array(F.col("s"), F.col("e") + 1)).alias("at"))
             .distinct())
    after = F.lead("at").over(Window.partitionBy("rng_bucket").orderBy("at"))
    segments = edges.withColumn("until", after - 1).where(F.col("until").isNotNull())
    c = cut.withColumnRenamed("rng_bucket", "b")
    won = (segments.join(c, (segments["rng_bucket"] == c["b"]) & (c["s"] <= segments["at"])
                         & (c["e"] >= segments["until"]))
           .groupBy("rng_bucket", "at", "until").agg(F.max("w").alias("w")))
    return won.select("rng_bucket", F.col("at").alias("eff_start"), F.col("until").alias("eff_end"),
                      F.col("w.district").alias("rng_district"))


def ip_to_district(df: DataFrame, ranges: DataFrame | None = None, ip_col: str = "ip",
                   out_col: str = "district", lookup: DataFrame | None = None) -> DataFrame:
    """Add ``out_col``: the district of ``ip_col`` (``'unknown'`` on a miss).

    Pass either raw ``ranges`` or a ``lookup`` from :func:`bucketed_ranges`.
    """
    if lookup is None:
        lookup = bucketed_ranges(ranges)
    ipl = ipv4_to_long(ip_col)
    facts = df.withColumns({"_ipl": ipl,
                            "_bkt": F.shiftright(ipl, BUCKET_BITS)})
    cond = ((facts["_bkt"] == lookup["rng_bucket"])
            & (facts["_ipl"] >= lookup["eff_start"])
            & (facts["_ipl"] <= lookup["eff_end"]))
    joined = facts.join(lookup, cond, "left")
    return (joined
            .withColumn(out_col, F.coalesce(F.col("rng_district"), F.lit(UNKNOWN_DISTRICT)))
            .drop("_ipl", "_bkt", "rng_bucket", "eff_start", "eff_end", "rng_district"))


def ip_unresolved_audit(located: DataFrame, ip_col: str = "ip",
                        district_col: str = "district") -> DataFrame:
    """IPs that found no district, with how many lines carried each."""
    return (located.where(F.col(district_col) == UNKNOWN_DISTRICT)
            .groupBy(ip_col).agg(F.count(F.lit(1)).alias("lines")))
