"""Visits, marts, roll-ups and top-N on hand-made facts."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from logloom.operators import marts, reports

IDS = ["districtid", "refererhostid", "devicetypeid", "columnid"]
SCHEMA = ("timeid string, ts long, sessionid string, districtid int, refererhostid int, "
          "devicetypeid int, columnid int, daystr string")


def fact(session, minute, device, sec=0, col=1, dis=1, ref=1):
    ts = 1_700_000_000 - (1_700_000_000 % 60) + minute * 60
    import datetime as dt
    t = dt.datetime.fromtimestamp(ts, dt.timezone.utc)
    timeid = t.strftime("%Y%m%d%H%M")
    return (timeid, ts, session, dis, ref, device, col, timeid + f"{sec:02d}")


def naive_visit_starts(facts, gaps):
    """The reference's formulation: lag over every request of the session."""
    w = Window.partitionBy("sessionid").orderBy("ts", "daystr", *IDS)
    lagged = facts.withColumn("fts", F.lag("ts").over(w))
    cond = F.col("fts").isNull()
    for dev, s in gaps.items():
        cond = cond | ((F.col("ts") - F.col("fts") >= s) & (F.col("devicetypeid") == dev))
    return lagged.where(cond).select("timeid", "ts", "sessionid", *IDS)


def _facts(spark):
    rows = []
    # PC (1, 300 s): gaps of 299 s (4 min 59 s -> minute grain 4 min), 5 min, 6 min
    rows += [fact("pc", 0, 1), fact("pc", 4, 1), fact("pc", 9, 1), fact("pc", 15, 1)]
    # mobile (2, 1800 s): gaps 29 min, 30 min
    rows += [fact("mob", 0, 2), fact("mob", 29, 2), fact("mob", 59, 2)]
    # ties inside one minute: the earliest second / smallest ids is credited
    rows += [fact("tie", 0, 1, sec=30, col=2), fact("tie", 0, 1, sec=10, col=3),
             fact("tie", 0, 1, sec=10, col=3), fact("tie", 7, 1, sec=5, col=4)]
    # unknown device (4): only the first request counts, however long the gap
    rows += [fact("unk", 0, 4), fact("unk", 500, 4)]
    # crossing midnight does not restart a visit by itself
    rows += [fact("mid", 1439, 2), fact("mid", 1441, 2)]
    return spark.createDataFrame(rows, SCHEMA)


def test_visit_starts_matches_reference_formulation(spark):
    facts = _facts(spark)
    gaps = marts.DEFAULT_VISIT_GAPS
    fast = sorted(tuple(r) for r in marts.visit_starts(facts).collect())
    slow = sorted(tuple(r) for r in naive_visit_starts(facts, gaps).collect())
    assert fast == slow
    by_session = {}
    for r in fast:
        by_session[r[2]] = by_session.get(r[2], 0) + 1
    assert by_session == {"pc": 3, "mob": 2, "tie": 2, "unk": 1, "mid": 1}
    tie_first = [r for r in fast if r[2] == "tie"][0]
    assert tie_first[6] == 3   # second 10 beats second 30


def test_visit_starts_random_agreement(spark):
    import random
    rnd = random.Random(3)
    rows = [fact(f"s{rnd.randrange(6)}", rnd.randrange(0, 300), rnd.choice([1, 2, 3]),
                 sec=rnd.randrange(3), col=rnd.randrange(1, 3), dis=rnd.randrange(1, 3))
            for _ in range(600)]
    facts = spark.createDataFrame(rows, SCHEMA)
    gaps = {1: 300, 2: 1800, 3: 60}
    fast = sorted(tuple(r) for r in marts.visit_starts(facts, gaps).collect())
    slow = sorted(tuple(r) for r in naive_visit_starts(facts, gaps).collect())
    assert fast == slow


def test_uv_pv_ip_marts(spark):
    facts = _facts(spark).withColumn("ip", F.concat(F.lit("1.1.1."), F.col("devicetypeid")))
    uv = marts.uv_mart(facts)
    assert uv.agg(F.sum("uv")).first()[0] == 9
    pv_day = marts.pv_mart(facts, "day")
    assert pv_day.agg(F.sum("pv")).first()[0] == facts.count()
    ipm = marts.ip_mart(facts)
    assert ipm.count() == facts.select(F.substring("timeid", 1, 8), "ip", *IDS).distinct().count()


def test_rollup_and_top_n(spark):
    mart = spark.createDataFrame(
        [("20240101", 1, 1, 1, c, pv) for c, pv in [(1, 5), (2, 7), (3, 7), (4, 1), (5, 9)]],
        "timeid string, districtid int, refererhostid int, devicetypeid int, columnid int, pv long")
    dim = spark.createDataFrame([(1, "v", "V"), (2, "c", "C"), (3, "p", "P"), (4, "s", "S"),
                                 (5, "s", "R")], "columnid int, keyword string, columnName string")
    by = reports.rollup_by(mart, dim, "column", "pv", "pv")
    top = reports.top_n(by, "timeid", "pv", 3, ["columnName"]).orderBy("rank").collect()
    assert [(r["columnName"], r["pv"], r["rank"]) for r in top] == [("R", 9, 1), ("C", 7, 2),
                                                                   ("P", 7, 3)]
    ipm = spark.createDataFrame([("20240101", "a", 1, 1, 1, 1), ("20240101", "a", 1, 1, 1, 2),
                                 ("20240101", "b", 1, 1, 1, 1)],
                                "timeid string, ip string, districtid int, refererhostid int, "
                                "devicetypeid int, columnid int")
    assert reports.ip_day_total(ipm).first()["ips"] == 3
    assert reports.ip_day_total(ipm, exact=True).first()["ips"] == 2


def test_visit_starts_with_a_hot_session(spark):
    """One session holds a third of all requests (many per minute)."""
    import random
    rnd = random.Random(9)
    rows = [fact("hot", rnd.randrange(0, 2000), rnd.choice([1, 2]), sec=rnd.randrange(60),
                 col=rnd.randrange(1, 4)) for _ in range(1500)]
    rows += [fact(f"s{rnd.randrange(200)}", rnd.randrange(0, 2000), rnd.choice([1, 2, 4]),
                  sec=rnd.randrange(60)) for _ in range(3000)]
    facts = spark.createDataFrame(rows, SCHEMA)
    gaps = marts.DEFAULT_VISIT_GAPS
    fast = marts.visit_starts(facts)
    assert sorted(map(tuple, fast.collect())) == \
        sorted(map(tuple, naive_visit_starts(facts, gaps).collect()))
    # the per-session window sees at most one row per (session, minute)
    hot_minutes = facts.where("sessionid = 'hot'").select("ts").distinct().count()
    assert fast.where("sessionid = 'hot'").count() <= hot_minutes


def test_visit_starts_of_days_with_a_carry(spark):
    """Any cut of the days gives the starts of the whole."""
    import random
    rnd = random.Random(5)
    rows = [fact(f"s{rnd.randrange(40)}", rnd.randrange(0, 4 * 1440), rnd.choice([1, 2, 4]), sec=rnd.randrange(60))
            for _ in range(1200)] + [fact("mid", 1439, 1), fact("mid", 1441, 1), fact("mid", 1446, 1)]
    facts = spark.createDataFrame(rows, SCHEMA).cache()
    whole = sorted(map(tuple, marts.visit_starts(facts).collect()))
    first = min(r[1] for r in rows)
    got, carry = [], None
    for cut in (first + 700 * 60, first + 1445 * 60, first + 1446 * 60, first + 9999 * 60):
        part = facts.where((F.col("ts") < cut) & (F.col("ts") >= (0 if carry is None else done)))
        minutes = marts.session_minutes(part)
        got += map(tuple, marts.starts_of_minutes(minutes, carry).collect())
        carry = spark.createDataFrame(marts.last_requests(minutes, carry).collect(), "sessionid string, ts long")
        done = cut
    assert sorted(got) == whole
    assert {r["sessionid"]: r["ts"] for r in carry.collect()} == {
        r["sessionid"]: r["m"] for r in facts.groupBy("sessionid").agg(F.max("ts").alias("m")).collect()}
    facts.unpersist()
