"""Inputs derived from the warehouse tables.

The warehouse holds no raw access log, IP-range file, dimension tables or
order bus, so they are derived -- by Spark, from the given tables -- with
fixed rules.  The DuckDB oracle rebuilds them with the same rules (see
``logloom.plans.oracle``), so both engines start from identical inputs.
Every row of the source tables is read.  The modulo arithmetic of the log
decides field values only (which request, status, referer, ...).  The order
bus carries the given ``orders``, ``lineitem`` and ``customer``: their keys,
dates, prices, discounts and flags are the fields of its records.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.functions import columns as C
from logloom.operators.orders import ORDER_TOPICS, PAYMENT_TOPICS

# ---------------------------------------------------------------------------
# Fixed values of the derived inputs (test-bed vocabulary).
# ---------------------------------------------------------------------------
AGENTS = [
    "Mozilla/5.0 (Linux; Android 10; SM-G975F) AppleWebKit/537.36 (KHTML, like Gecko) Mobile Safari/537.36",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 13_5 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Mobile/15E148",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/83.0 Safari/537.36",
    "DNSPod-Monitor/1.0",
    "curl/7.68.0",
]
# site columns: (columnid, keyword in the URL, label); 'error' pages have no
# column, and 'signup' appears twice (a duplicated dimension key)
COLUMN_ROWS = [(1, "view", "View"), (2, "click", "Click"), (3, "purchase", "Purchase"),
               (4, "signup", "Signup"), (5, "signup", "Register")]
# device ids: 1 = PC, 2 = mobile, then the other classes
DEVICE_ROWS = [(1, C.DEVICE_PC), (2, C.DEVICE_MOBILE), (3, C.DEVICE_MONITOR),
               (4, C.DEVICE_UNKNOWN)]
REFERER_ROWS = [(1, "host1.example.com", "host1"), (2, "host2.example.com", "host2"),
                (3, "host3.example.com", "host3")]
# topics come from the operators; the bus has this many partitions
BUS_PARTITIONS = 4
# a given agent dictionary: it disagrees with the rules on some agents (an
# iPhone listed as PC, curl as a monitor) and lacks others (misses)
AGENT_DICTIONARY = [(AGENTS[0], C.DEVICE_MOBILE), (AGENTS[1], C.DEVICE_PC),
                    (AGENTS[2], C.DEVICE_PC), (AGENTS[4], C.DEVICE_MONITOR)]
# the bus is kept in segments of about so many records, in so many at least
SEGMENT_RECORDS = 100_000
BUS_SEGMENTS = 8
# ---------------------------------------------------------------------------


def _eid() -> Column:
    return F.col("event_id")


def request_line() -> Column:
    e = _eid()
    et = F.col("event_type")
    return (F.when(e % 13 == 0, F.lit("GET / HTTP/1.1"))
            .when(e % 11 == 0, F.lit("GET /static/app.css HTTP/1.1"))
            .when(e % 19 == 0, F.concat(F.lit("GET /"), et, F.lit("/feed.json HTTP/1.1")))
            .when(e % 23 == 0, F.concat(F.lit("GET /"), et, F.lit("/banner.JPG HTTP/1.1")))
            .otherwise(F.concat(F.lit("GET /"), et, F.lit("/"), (e % 7).cast("string"),
                                F.lit(".html HTTP/1.1"))))


def _status() -> Column:
    e = _eid()
    return F.when(e % 10 == 8, "404").when(e % 10 == 9, "500").otherwise("200")


def _bytes() -> Column:
    e = _eid()
    return F.when(e % 31 == 0, F.lit("-")).otherwise((e % 5000).cast("string"))


def _referer() -> Column:
    e = _eid()
    return F.when(e % 4 == 0, F.lit("-")).otherwise(
        F.concat(F.lit("http://host"), (e % 4).cast("string"), F.lit(".example.com/x")))


def _agent() -> Column:
    u = F.col("user_id") % len(AGENTS)
    expr = F.when(u == 0, F.lit(AGENTS[0]))
    for i, a in enumerate(AGENTS[1:], start=1):
        expr = expr.when(u == i, F.lit(a))
    return expr


def _ip() -> Column:
    return F.concat(((F.col("user_id") * 7) % 256).cast("string"), F.lit("."),
                    (_eid() % 256).cast("string"), F.lit(".0.1"))


def access_log_lines(events: DataFrame) -> DataFrame:
    """One access-log line per event (``value``); every 17th is garbage."""
    dt = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" +0800"))
    line = F.concat(_ip(), F.lit(" s"), F.col("user_id").cast("string"),
                    F.lit(" ["), dt, F.lit('] "'), request_line(), F.lit('" '),
                    _status(), F.lit(" "), _bytes(), F.lit(' "'), _referer(),
                    F.lit('" "'), _agent(), F.lit('"'))
    bad = F.concat(F.lit("garbage "), _eid().cast("string"))
    return events.select(F.when(_eid() % 17 == 0, bad).otherwise(line).alias("value"))


def combined_log_lines(events: DataFrame) -> DataFrame:
    """The same events in Apache combined format (``ip - - [dd/MMM/yyyy:...]``)."""
    dt = F.concat(F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0800"))
    line = F.concat(_ip(), F.lit(" - - ["), dt, F.lit('] "'), request_line(),
                    F.lit('" '), _status(), F.lit(" "), _bytes(), F.lit(' "'),
                    _referer(), F.lit('" "'), _agent(), F.lit('"'))
    return events.select(line.alias("value"))


def ip_range_lines(nation: DataFrame, region: DataFrame) -> DataFrame:
    """IP-range file lines: nation k owns first octets 10k .. 10k+7.

    Lines carry irregular whitespace.  Inside nation k's range, region k's
    line nests a range of its own district.  Bad lines must not pass: too few
    fields, octets over 255, start above end.
    """
    k = F.col("n_nationkey").cast("bigint")
    nat = nation.select(F.concat(
        F.lit("  "), (k * 10).cast("string"), F.lit(".0.0.0\t"),
        (k * 10 + 7).cast("string"), F.lit(".255.255.255   "),
        F.col("n_name"), F.lit(" ")).alias("value"))
    r = F.col("r_regionkey").cast("string")
    name = F.replace("r_name", F.lit(" "), F.lit("_"))
    reg = region.select(F.explode(F.array(
        F.concat(F.col("r_name"), F.lit(" "), r),
        F.concat(r, F.lit("0.64.0.0 "), r, F.lit("0.127.255.255 "), name),
        F.concat(r, F.lit("99999.0.0.0 "), r, F.lit("99999.0.0.9 "), name),
        F.concat(r, F.lit("5.9.0.0 "), r, F.lit("5.1.0.0 "), name))).alias("value"))
    return nat.unionByName(reg)


def agent_dictionary(spark: SparkSession) -> DataFrame:
    """The given (userAgent, deviceType) dictionary."""
    return literal_table(spark, AGENT_DICTIONARY, ["userAgent", "deviceType"])


@dataclass(frozen=True)
class Dimensions:
    """The five dimensions of the star join."""
    calendar: DataFrame   # timeid, year, month, day, hour, minute
    columns: DataFrame    # columnid, keyword, columnName
    devices: DataFrame    # devicetypeid, deviceTypeName
    districts: DataFrame  # districtid, districtName
    referers: DataFrame   # refererHostId, url, host


def _sql_literal(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


def literal_table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small table from literal rows as an inline ``VALUES`` relation.

    Unlike ``createDataFrame`` over a Python list (an RDD scan of unknown
    size), an inline table carries exact statistics, so the planner knows
    it is tiny and broadcasts it without any extra job.
    """
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")


def dimensions(spark: SparkSession, nation: DataFrame, calendar: DataFrame) -> Dimensions:
    """The dimensions beside a given calendar."""
    columns = literal_table(spark, COLUMN_ROWS, ["columnid", "keyword", "columnName"])
    devices = literal_table(spark, DEVICE_ROWS, ["devicetypeid", "deviceTypeName"])
    referers = literal_table(spark, REFERER_ROWS, ["refererHostId", "url", "host"])
    districts = nation.select(F.col("n_nationkey").cast("int").alias("districtid"),
                              F.col("n_name").alias("districtName"))
    return Dimensions(calendar, columns, devices, districts, referers)


def _cents_str(cents: Column) -> Column:
    """Integer cents -> ``'12.30'`` (exact, no float formatting)."""
    return F.concat(F.floor(cents / 100).cast("bigint").cast("string"), F.lit("."),
                    F.lpad((cents % 100).cast("string"), 2, "0"))


def _placed(orders: DataFrame) -> DataFrame:
    """Order key and the minute it was placed (the given date has no time)."""
    return orders.select("*", F.timestamp_add(
        "MINUTE", (F.col("o_orderkey") % 1440).cast("int"),
        F.col("o_orderdate").cast("timestamp_ntz")).alias("placed"))


def order_records(orders: DataFrame, lineitem: DataFrame, customer: DataFrame) -> DataFrame:
    """Every given order as a CSV record (userId, orderid, addressId, ordertime,
    goodsamount, carriage, discountamount, amount) plus topic and key columns.

    Orders in status P arrive as carried-forward ones (``order2``), all others
    as new ones; a tenth of the urgent ones is delivered again a day later.  A
    tenth of the low-priority ones has no readable time.  Goods are the total
    price scaled to shop amounts, the discount is the greatest of the order's
    line items.  The record's carriage is always 0: the shipping charge is
    computed from the goods by ``order_amounts``.
    """
    disc = lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(
        F.max(F.round(F.col("l_discount") * 100)).cast("bigint").alias("pct"))
    o = (_placed(orders)
         .join(disc, F.col("o_orderkey") == F.col("k"), "left")
         .join(customer.select("c_custkey", "c_nationkey"),
               F.col("o_custkey") == F.col("c_custkey"), "left"))
    goods = F.floor(F.col("o_totalprice") / 40).cast("bigint")
    off = F.floor(goods * F.coalesce("pct", F.lit(0)) / 100).cast("bigint")
    unread = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderkey") % 10 == 0)
    time = F.when(unread, F.lit("n/a")).otherwise(F.date_format("placed", "yyyy-MM-dd HH:mm:ss"))
    key = F.col("o_orderkey").cast("string")
    csv = F.concat_ws(",", F.col("o_custkey").cast("string"), key,
                      F.concat(F.lit("nation"), F.coalesce(F.col("c_nationkey").cast("string"), F.lit("?"))),
                      time, _cents_str(goods), F.lit("0.00"), _cents_str(off), _cents_str(goods - off))
    again = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderkey") % 10 == 1)
    topic = F.when(F.col("o_orderstatus") == "P", ORDER_TOPICS[1]).otherwise(ORDER_TOPICS[0])
    first = o.select(topic.alias("topic"), key.alias("orderid"), F.col("o_orderkey").alias("order_no"),
                     F.col("placed").alias("event_ts"), csv.alias("value"), again.alias("again"))
    later = first.where("again").select(
        F.lit(ORDER_TOPICS[1]).alias("topic"), "orderid", "order_no",
        (F.col("event_ts") + F.expr("INTERVAL 1 DAY")).alias("event_ts"), "value")
    return first.drop("again").unionByName(later)


def payment_records(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Every given line item as a payment: orderid, payment, paymenttime,
    bonus, paymenttype.

    Flag A pays ``quantity - 20`` minutes after the order (early, in time or
    late), the others ``quantity`` minutes after; N with line status F has no
    time.  Items that were returned (flag R) pay, as carried-forward payments
    (``pay2``), for an order number of their own that no order has.  An order
    can have several payments, or none.  An item without an order is dated by
    its shipping day.
    """
    li = lineitem.join(_placed(orders).select("o_orderkey", "placed"),
                       F.col("l_orderkey") == F.col("o_orderkey"), "left").withColumn(
        "placed", F.coalesce("placed", F.col("l_shipdate").cast("timestamp_ntz")))
    qty = F.col("l_quantity").cast("int")
    at = F.timestamp_add("MINUTE", F.when(F.col("l_returnflag") == "A", qty - 20).otherwise(qty),
                         F.col("placed"))
    untimed = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F")
    returned = F.coalesce(F.col("l_returnflag") == "R", F.lit(False))
    time = F.when(untimed, F.lit("")).otherwise(F.date_format(at, "yyyy-MM-dd HH:mm:ss"))
    key = F.concat(F.when(returned, F.lit("returned")).otherwise(F.lit("")), F.col("l_orderkey").cast("string"))
    csv = F.concat_ws(",", key, F.concat(F.lit("supplier"), F.col("l_suppkey").cast("string")), time,
                      F.round(F.col("l_discount") * 100).cast("bigint").cast("string"),
                      F.concat(F.lit("line"), F.col("l_linenumber").cast("string")))
    return li.select(F.when(returned, PAYMENT_TOPICS[1]).otherwise(PAYMENT_TOPICS[0]).alias("topic"),
                     key.alias("orderid"), F.col("l_orderkey").alias("order_no"),
                     F.when(untimed, F.col("placed")).otherwise(at).alias("event_ts"),
                     csv.alias("value"))


def delivery_records(customer: DataFrame) -> DataFrame:
    """Customers as delivery CSV records: userId, addressId, address (market
    segment), linkman (name), phonenum (balance digits)."""
    csv = F.concat_ws(
        ",", F.col("c_custkey").cast("string"),
        F.concat(F.lit("nation"), F.col("c_nationkey").cast("string")), F.col("c_mktsegment"),
        F.col("c_name"), F.floor(F.abs("c_acctbal")).cast("bigint").cast("string"))
    return customer.select(csv.alias("value"))


BUS_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])


#: Which positions a segment of the bus holds.
INDEX_SCHEMA = "topic string, partition int, segment int, from_offset bigint, until_offset bigint"


def bus_records(orders: DataFrame, lineitem: DataFrame, customer: DataFrame) -> DataFrame:
    """Order and payment records: topic, partition (by the order number),
    timestamp, key, value."""
    every = order_records(orders, lineitem, customer).unionByName(payment_records(orders, lineitem))
    return every.select(
        "topic", (F.col("order_no") % BUS_PARTITIONS).cast("int").alias("partition"),
        F.col("event_ts").alias("timestamp"), F.col("orderid").alias("key"), "value")


def _second(ts: Column) -> Column:
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def with_segments(records: DataFrame) -> DataFrame:
    """``segment`` of each record: the bus is kept in segments of equal time,
    as it arrives, of about ``SEGMENT_RECORDS`` records each."""
    lo, hi, n = records.agg(F.min(_second(F.col("timestamp"))), F.max(_second(F.col("timestamp"))),
                            F.count(F.lit(1))).first()
    segments = max(BUS_SEGMENTS, -(-n // SEGMENT_RECORDS))
    at = F.floor((_second(F.col("timestamp")) - (lo or 0)) * segments / ((hi or 0) - (lo or 0) + 1))
    return records.withColumn("segment", at.cast("int"))


def segment_counts(segmented: DataFrame) -> DataFrame:
    """``topic, partition, segment, from_offset, until_offset``: which positions
    of a topic's partition a segment holds (a row each, partially counted)."""
    counts = segmented.groupBy("topic", "partition", "segment").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("topic", "partition").orderBy("segment"))
    return counts.select("topic", "partition", "segment", (upto - F.col("n")).alias("from_offset"),
                         upto.alias("until_offset"))


def with_offsets(segmented: DataFrame, counts: DataFrame) -> DataFrame:
    """Bus rows: the offset is the record's place in its topic's partition,
    counted without gaps in order of time.  Only records of one segment, topic
    and partition are sorted together.  The rows are dealt by segment, once, and
    stay where they lie when they are numbered and written by segment."""
    within = Window.partitionBy("segment", "topic", "partition").orderBy("timestamp", "key", "value")
    # as many parts as segments: what a task sorts does not grow with the bus
    parts = (counts.agg(F.max("segment")).first()[0] or 0) + 1
    numbered = segmented.repartition(parts, "segment").withColumn("_n", F.row_number().over(within) - 1)
    return numbered.join(F.broadcast(counts.select("topic", "partition", "segment", "from_offset")),
                         ["topic", "partition", "segment"]).select(
        "topic", "partition", (F.col("from_offset") + F.col("_n")).alias("offset"), "timestamp", "key",
        "value", "segment")


def geo_replies(located: DataFrame) -> DataFrame:
    """Stored geo-IP replies for located IPs (``ip``, ``district``).

    Known districts get a JSON object whose ``region`` starts with a
    ``\\uXXXX`` escape; unknown ones get the short invalid-IP answer.
    """
    d = F.col("district")
    escaped = F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(F.ascii(d)), 4, "0")),
                       F.substring(d, 2, 1 << 20))
    ok = F.concat(F.lit('{"code":0,"data":{"ip":"'), F.col("ip"),
                  F.lit('","country":"XX","region":"'), escaped,
                  F.lit('","isp":"\\u7535\\u4fe1"}}'))
    reply = F.when(d == C.UNKNOWN_DISTRICT, F.lit('{"code":1,"data":"invalid ip"}')).otherwise(ok)
    return located.select("ip", reply.alias("reply"))
