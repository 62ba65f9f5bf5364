"""Row-level rules: golden literals and edge rows, plus models of Java's
``String.split`` for the column / referer rules."""

import random
import re

from pyspark.sql import functions as F

from logloom.functions import columns as C
from logloom.functions import parse as P

# Sample lines of the two log formats.
SAMPLE_LINE = ('61.169.62.163 80b378fb-b846-439d-8e0c-8835b08d66bb [2017-01-08 12:01:20 +0800] '
               '"GET /wp-content/uploads/2016/07/ggplot2.png HTTP/1.1" 200 817 "-" '
               '"Mozilla/5.0 (Windows; U; Windows NT 6.1; ) AppleWebKit/534.12 (KHTML, like '
               'Gecko) Maxthon/3.0 Safari/534.12"')
COMBINED_LINE = ('10.1.1.95 - - [18/Mar/2005:12:21:42 +0800] "GET /stats/awstats.pl?config=e800 '
                 'HTTP/1.1" 200 899 "http://10.1.1.1/pv/" "Mozilla/4.0 (compatible; MSIE 6.0; '
                 'Windows NT 5.1; Maxthon)"')


def java_split(s: str, regex: str) -> list[str]:
    """Java ``String.split(regex)``: trailing empty strings are dropped."""
    if s == "":
        return [""]
    parts = re.split(regex, s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def model_column(url: str) -> str:
    try:
        if len(java_split(url, r"\s+")) == 3:
            return java_split(java_split(java_split(url, " ")[1], "/")[1], r"\.")[0]
        return ""
    except IndexError:  # the reference throws here; we return ''
        return ""


def model_referer(ref: str) -> str:
    parts = java_split(ref, "/")
    return parts[2] if len(parts) >= 3 else "-"


def _one(spark, col, value):
    return spark.createDataFrame([(value,)], "v string").select(col.alias("r")).first()["r"]


def test_ipv4_to_long_golden(spark):
    df = spark.createDataFrame([("54.32.33.14",), ("0.0.0.0",), ("255.255.255.255",),
                                ("1.2.x.4",), ("1.2.3",), ("",)], "ip string")
    got = [r[0] for r in df.select(C.ipv4_to_long("ip")).collect()]
    assert got == [908075278, 0, 4294967295, None, None, None]


def test_long_to_ipv4_roundtrip(spark):
    df = spark.createDataFrame([("54.32.33.14",), ("10.0.255.1",)], "ip string")
    got = [r[0] for r in df.select(C.long_to_ipv4(C.ipv4_to_long("ip"))).collect()]
    assert got == ["54.32.33.14", "10.0.255.1"]


def test_status_and_static_filters(spark):
    st = spark.createDataFrame([(s,) for s in ["404", "500", "302", "4000", "200"]], "s string")
    assert [r[0] for r in st.select(C.is_error_status("s")).collect()] == \
        [True, True, False, False, False]
    reqs = ["GET /a.json HTTP/1.1", "GET /a.jsp HTTP/1.1", "GET /a.JPG HTTP/1.1",
            "GET /x.css?v=1 HTTP/1.1", "GET /page.html HTTP/1.1"]
    df = spark.createDataFrame([(r,) for r in reqs], "u string")
    regex = [r[0] for r in df.select(C.is_static_resource("u")).collect()]
    substr = [r[0] for r in df.select(C.is_static_resource_substring("u")).collect()]
    assert regex == substr == [True, True, False, True, False]


def test_daystr_and_splits(spark):
    dt = "2017-01-08 00:38:04 +0800"
    assert _one(spark, C.daystr("v"), dt) == "20170108003804"
    assert _one(spark, C.yearmonthday("v"), dt) == "20170108"
    assert _one(spark, C.yearmonth("v"), dt) == "201701"
    y, m, d = C.split_ymd_str("v")
    df = spark.createDataFrame([("20170108",)], "v string")
    assert tuple(df.select(y, m, d).first()) == ("2017", "01", "08")
    y, m, d = C.split_ymd_int("v")
    df = spark.createDataFrame([("20170108003752",)], "v string")
    assert tuple(df.select(y, m, d).first()) == (2017, 1, 8)


def test_time_interval_golden(spark):
    df = spark.createDataFrame([("2019-01-01 23:19:07 +0800", "2019-01-01 23:09:07 +0800"),
                                ("2019-09-01 12:05:00", "2019-09-01 12:00:00")], "a string, b string")
    r = df.select(C.time_interval_seconds("a", "b").alias("z")).first()["z"]
    assert r == 600
    r2 = df.select(C.time_interval_seconds("a", "b", "yyyy-MM-dd HH:mm:ss").alias("z")).collect()
    assert r2[1]["z"] == 300   # exactly five minutes: not "more than 5 minutes"


def test_column_name_edges_match_java_model(spark):
    edges = ["GET /wp-content/uploads/2016/07/ggplot2.png HTTP/1.1", "GET / HTTP/1.1",
             "GET /.x HTTP/1.1", "GET /. HTTP/1.1", "GET * HTTP/1.1", "GET  /a HTTP/1.1",
             "GET http://h.com/a HTTP/1.1", "GET /a HTTP/1.1 ", "GET /?p=1.2 HTTP/1.1",
             "GET/auto.xxx.cn/tag/waitoutputthreads/images/stories/cr0t.php?conf HTTP/1.1",
             " GET /a HTTP/1.1", "", "GET a/b HTTP/1.1", "GET //a HTTP/1.1", "GET /a/ HTTP/1.1"]
    rnd = random.Random(7)
    alphabet = ["GET", " ", "/", ".", "a", "b.c", "\t", "HTTP/1.1", "//", ".."]
    randoms = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 8))) for _ in range(300)]
    inputs = edges + randoms
    df = spark.createDataFrame([(i, u) for i, u in enumerate(inputs)], "i int, u string")
    got = {r["i"]: r["c"] for r in df.select("i", C.column_name("u").alias("c")).collect()}
    for i, u in enumerate(inputs):
        assert got[i] == model_column(u), (u, got[i], model_column(u))
    assert got[0] == "wp-content"
    assert got[9] == ""   # two tokens: no column


def test_referer_host_matches_java_model(spark):
    edges = ["", "-", "http://", "http://h", "http://h/", "http:///x", "http://10.1.1.1/pv/",
             "a//", "/", "http://h//x//"]
    rnd = random.Random(11)
    randoms = ["".join(rnd.choice(["http:", "/", "h", "x.y", "//"]) for _ in range(rnd.randint(0, 6)))
               for _ in range(200)]
    inputs = edges + randoms
    df = spark.createDataFrame([(i, u) for i, u in enumerate(inputs)], "i int, u string")
    got = {r["i"]: r["h"] for r in df.select("i", C.referer_host("u").alias("h")).collect()}
    for i, u in enumerate(inputs):
        assert got[i] == model_referer(u), (u, got[i])
    assert got[6] == "10.1.1.1"


def test_device_type_rules(spark):
    agents = ["Mozilla/5.0 (Windows Phone 8.0; Windows NT 6.2)", "Mozilla/5.0 (Windows NT 10.0)",
              "DNSPod-Monitor/1.0", "curl/7", "Mozilla (iPad; CPU OS 9)", SAMPLE_LINE]
    df = spark.createDataFrame([(a,) for a in agents], "a string")
    got = [r[0] for r in df.select(C.device_type("a")).collect()]
    assert got == [C.DEVICE_MOBILE, C.DEVICE_PC, C.DEVICE_UNKNOWN, C.DEVICE_UNKNOWN,
                   C.DEVICE_MOBILE, C.DEVICE_PC]
    fixed = df.select(C.device_type("a", fix_monitor_rule=True)).collect()[2][0]
    assert fixed == C.DEVICE_MONITOR


def test_region_from_ip_json(spark):
    reply = ('{"code":0,"data":{"ip":"171.15.255.255","country":"\\u4e2d\\u56fd","area":"",'
             '"region":"\\u6cb3\\u5357","city":"\\u4fe1\\u9633","isp":"\\u7535\\u4fe1"}}')
    assert _one(spark, C.region_from_ip_json("v"), reply) == "河南"
    assert _one(spark, C.region_from_ip_json("v"), '{"code":1,"data":"x"}') == "0"


def test_order_amounts_rule(spark):
    df = spark.createDataFrame([(30.0, 0.0), (50.0, 7.5), (120.0, 18.0)], "g double, d double")
    got = [tuple(r) for r in df.select(C.carriage("g"), C.order_amount("g", "d")).collect()]
    assert got == [(10.0, 40.0), (5.0, 47.5), (0.0, 102.0)]


def test_parse_sample_line(spark):
    lines = spark.createDataFrame([(SAMPLE_LINE,), ("garbage 17",),
                                   (SAMPLE_LINE.replace(" 817 ", " - "),)], "value string")
    parsed = P.access_log_parse(lines).collect()
    assert len(parsed) == 1   # non-matching line and bytes '-' give no row
    r = parsed[0]
    assert r["ip"] == "61.169.62.163"
    assert r["sessionid"] == "80b378fb-b846-439d-8e0c-8835b08d66bb"
    assert r["datetime"] == "2017-01-08 12:01:20 +0800"
    assert r["url"] == "GET /wp-content/uploads/2016/07/ggplot2.png HTTP/1.1"
    assert (r["status"], r["sentBytes"], r["referal"]) == ("200", "817", "-")
    assert r["daystr"] == "20170108120120" and r["yearmonthday"] == "20170108"
    cov = P.parse_coverage(lines).first()
    assert (cov["matched"], cov["unmatched"], cov["bad_time"]) == (1, 2, 0)
    garbled = lines.withColumn("value", F.replace("value", F.lit("2017-01-08 12"), F.lit("not a time 12")))
    assert tuple(P.parse_coverage(garbled).first()) == (1, 2, 1)
    typed = P.weblog_parse_typed(lines).first()
    assert str(typed["time"]) == "2017-01-08 12:01:20"


def test_parse_combined_line(spark):
    lines = spark.createDataFrame([(COMBINED_LINE,)], "value string")
    r = P.request_split_parse(lines).first()
    assert (r["method"], r["target"], r["protocol"]) == ("GET", "/stats/awstats.pl?config=e800",
                                                         "HTTP/1.1")
    assert r["identity"] == "- -"
    df = lines.select(C.referer_host(F.lit("http://10.1.1.1/pv/")).alias("h"))
    assert df.first()["h"] == "10.1.1.1"


def test_parse_monthly(spark):
    lines = spark.createDataFrame([(SAMPLE_LINE,)], "value string")
    r = P.access_log_parse_monthly(lines).first()
    assert (r["district"], r["daystr"], r["yearmonthday"]) == ("", "201701", "201701")
