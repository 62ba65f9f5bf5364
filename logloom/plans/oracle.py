"""DuckDB oracle SQL for every query of the catalogue.

Written independently of the Spark plans and with literals of its own:
straightforward SQL (regex extraction per group, containment join for the IP
ranges, plain ``lag`` window for visits, per-order subqueries for payments)
over the same warehouse tables, rebuilding the derived inputs with the same
rules as ``logloom.sources.derived``.  Output column names and types match
the Spark queries.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values, stated here again so that the engine's own are checked.
# ---------------------------------------------------------------------------
ACCESS_LOG = r'(\S+) (.+) \[(.+)\] "(.*)" (\d+) (\d+) "(.*)" "(.*)"'
ACCESS_LOG_FIELDS = ["ip", "sessionid", "datetime", "url", "status", "sentBytes", "referal",
                     "userAgent"]
WEBLOG_STRICT = r'(\S+) (\S+) \[(.+)\] "(\S+ \S+ \S+)" (\d+) (\d+) "(\S+)" "(.+)"'
WEBLOG_FIELDS = ["ip", "sessionid", "time", "url", "status", "sentBytes", "referer", "userAgent"]
COMBINED_LOG = r'(\S+) (.+) \[(.+)\] "(\S+) (\S+) (\S+)" (\d+) (\d+) "(\S+)" "(.+)"'
COMBINED_FIELDS = ["ip", "identity", "datetime", "method", "target", "protocol", "status",
                   "sentBytes", "referer", "userAgent"]
AGENTS = [
    "Mozilla/5.0 (Linux; Android 10; SM-G975F) AppleWebKit/537.36 (KHTML, like Gecko) Mobile Safari/537.36",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 13_5 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Mobile/15E148",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/83.0 Safari/537.36",
    "DNSPod-Monitor/1.0",
    "curl/7.68.0",
]
PC, MOBILE, MONITOR, UNKNOWN = "PC端", "移动端", "域名监控", "unknown"
MOBILE_WORDS = ["android", "windows phone", "iphone", "ipad", "ipod"]
PC_WORD, MONITOR_WORD = "windows nt", "DNSPod-Monitor/1.0"
STATIC = ["css", "png", "jpg", "js", "ico", "gif"]
COLUMNS = [(1, "view", "View"), (2, "click", "Click"), (3, "purchase", "Purchase"),
           (4, "signup", "Signup"), (5, "signup", "Register")]
DEVICES = [(1, PC), (2, MOBILE), (3, MONITOR), (4, UNKNOWN)]
REFERERS = [(1, "host1.example.com", "host1"), (2, "host2.example.com", "host2"),
            (3, "host3.example.com", "host3")]
DICTIONARY = [(AGENTS[0], MOBILE), (AGENTS[1], PC), (AGENTS[2], PC), (AGENTS[4], MONITOR)]
# ---------------------------------------------------------------------------


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _v(e: str) -> str:
    return f"CAST({e} AS VARCHAR)"


def _ip2long(e: str) -> str:
    parts = [f"TRY_CAST(split_part({e}, '.', {i}) AS BIGINT)" for i in range(1, 5)]
    ok = " AND ".join(f"{p} IS NOT NULL" for p in parts)
    return (f"(CASE WHEN len(string_split({e}, '.')) = 4 AND {ok} THEN "
            f"({parts[0]} << 24) | ({parts[1]} << 16) | ({parts[2]} << 8) | {parts[3]} END)")


_REQUEST = (
    "CASE WHEN event_id % 13 = 0 THEN 'GET / HTTP/1.1' "
    "WHEN event_id % 11 = 0 THEN 'GET /static/app.css HTTP/1.1' "
    "WHEN event_id % 19 = 0 THEN 'GET /' || event_type || '/feed.json HTTP/1.1' "
    "WHEN event_id % 23 = 0 THEN 'GET /' || event_type || '/banner.JPG HTTP/1.1' "
    f"ELSE 'GET /' || event_type || '/' || {_v('event_id % 7')} || '.html HTTP/1.1' END")
_STATUS = "CASE event_id % 10 WHEN 8 THEN '404' WHEN 9 THEN '500' ELSE '200' END"
_BYTES = f"CASE WHEN event_id % 31 = 0 THEN '-' ELSE {_v('event_id % 5000')} END"
_REFERER = (f"CASE WHEN event_id % 4 = 0 THEN '-' ELSE 'http://host' || {_v('event_id % 4')}"
            " || '.example.com/x' END")
_AGENT = ("CASE user_id % 5 " + " ".join(f"WHEN {i} THEN {_q(a)}" for i, a in enumerate(AGENTS))
          + " END")
_IP = f"{_v('(user_id * 7) % 256')} || '.' || {_v('event_id % 256')} || '.0.1'"


def _device_sql(agent: str) -> str:
    low = f"lower({agent})"
    mobile = " OR ".join(f"contains({low}, {_q(k)})" for k in MOBILE_WORDS)
    return (f"CASE WHEN {mobile} THEN {_q(MOBILE)} "
            f"WHEN contains({low}, {_q(PC_WORD)}) THEN {_q(PC)} "
            f"WHEN contains({low}, {_q(MONITOR_WORD)}) THEN {_q(MONITOR)} "
            f"ELSE {_q(UNKNOWN)} END")


def _column_sql(url: str) -> str:
    return (f"CASE WHEN len(string_split_regex(regexp_replace({url}, '\\s+$', ''), '\\s+')) = 3 "
            f"THEN split_part(split_part(split_part({url}, ' ', 2), '/', 2), '.', 1) ELSE '' END")


def _referer_sql(ref: str) -> str:
    parts = f"string_split(regexp_replace({ref}, '/+$', ''), '/')"
    return f"CASE WHEN len({parts}) >= 3 THEN {parts}[3] ELSE '-' END"


def _groups_sql(col: str, pattern: str, names: list[str]) -> str:
    anchored = _q("^" + pattern + "$")
    return ", ".join(f"regexp_extract({col}, {anchored}, {i + 1}) AS {n}"
                     for i, n in enumerate(names))


def _daystr_sql(dt: str) -> str:
    return f"substr(replace(replace(replace({dt}, '-', ''), ' ', ''), ':', ''), 1, 14)"


def _values(rows, names) -> str:
    vals = ", ".join("(" + ", ".join(_q(v) if isinstance(v, str) else str(v) for v in r) + ")"
                     for r in rows)
    return f"SELECT * FROM (VALUES {vals}) AS t({', '.join(names)})"


_STATIC = "|".join(STATIC)

CTES: list[tuple[str, str]] = [
    ("lines", f"""
SELECT CASE WHEN event_id % 17 = 0 THEN 'garbage ' || {_v('event_id')} ELSE
  {_IP} || ' s' || {_v('user_id')} || ' [' || strftime(ts, '%Y-%m-%d %H:%M:%S') || ' +0800] "'
  || ({_REQUEST}) || '" ' || ({_STATUS}) || ' ' || ({_BYTES}) || ' "' || ({_REFERER})
  || '" "' || ({_AGENT}) || '"' END AS value
FROM events"""),
    ("combined_lines", f"""
SELECT {_IP} || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0800] "' || ({_REQUEST})
  || '" ' || ({_STATUS}) || ' ' || ({_BYTES}) || ' "' || ({_REFERER}) || '" "' || ({_AGENT})
  || '"' AS value
FROM events"""),
    ("parsed0", f"""
SELECT {_groups_sql('value', ACCESS_LOG, ACCESS_LOG_FIELDS)}
FROM lines WHERE regexp_full_match(value, {_q(ACCESS_LOG)})"""),
    ("parsed", f"""
SELECT *, {_daystr_sql('datetime')} AS daystr,
       substr(replace(datetime, '-', ''), 1, 8) AS yearmonthday
FROM parsed0"""),
    ("range_lines", """
SELECT '  ' || CAST(n_nationkey * 10 AS VARCHAR) || '.0.0.0' || chr(9)
       || CAST(n_nationkey * 10 + 7 AS VARCHAR) || '.255.255.255   ' || n_name || ' ' AS value
FROM nation
UNION ALL
SELECT unnest([r_name || ' ' || r, r || '0.64.0.0 ' || r || '0.127.255.255 ' || name,
               r || '99999.0.0.0 ' || r || '99999.0.0.9 ' || name,
               r || '5.9.0.0 ' || r || '5.1.0.0 ' || name])
FROM (SELECT r_name, CAST(r_regionkey AS VARCHAR) AS r, replace(r_name, ' ', '_') AS name FROM region)"""),
    ("range_fields", """
SELECT string_split_regex(regexp_replace(value, '^\\s+|\\s+$', '', 'g'), '\\s+') AS f
FROM range_lines"""),
    ("ranges", f"""
SELECT * FROM (
  SELECT {_ip2long('f[1]')} AS start_ip, {_ip2long('f[2]')} AS end_ip, f[3] AS district
  FROM range_fields WHERE len(f) = 3
    AND list_max(list_transform(string_split(f[1] || '.' || f[2], '.'), lambda x: TRY_CAST(x AS INTEGER))) <= 255)
WHERE start_ip <= end_ip"""),
    ("ip_district", f"""
SELECT ip, coalesce(arg_max(district, start_ip), 'unknown') AS district
FROM (SELECT DISTINCT ip, {_ip2long('ip')} AS ipl FROM parsed)
LEFT JOIN ranges ON start_ip <= ipl AND ipl <= end_ip GROUP BY ip"""),
    ("kept", f"""
SELECT *, {_ip2long('ip')} AS ipl FROM parsed
WHERE NOT regexp_matches(status, '^[45]\\d{{2}}$')
  AND NOT regexp_matches(url, '\\.({_STATIC})')"""),
    ("located", "SELECT k.*, d.district FROM kept k JOIN ip_district d ON k.ip = d.ip"),
    ("loginfo", """
SELECT ip, district, sessionid, datetime, daystr, url, status, sentBytes, referal, userAgent,
       substr(yearmonthday, 1, 4) AS year, substr(yearmonthday, 5, 2) AS month,
       substr(yearmonthday, 7) AS day
FROM located"""),
    ("loginfo2", f"""
SELECT ip, district, sessionid, datetime, daystr,
       {_column_sql('url')} AS columnName,
       {_referer_sql('referal')} AS refererHost,
       {_device_sql('userAgent')} AS deviceType,
       TRY_CAST(substr(daystr, 1, 4) AS INTEGER) AS year,
       TRY_CAST(substr(daystr, 5, 2) AS INTEGER) AS month,
       TRY_CAST(substr(daystr, 7, 2) AS INTEGER) AS day
FROM loginfo"""),
    ("calendar", """
SELECT DISTINCT strftime(ts, '%Y%m%d') || lpad(CAST(m // 60 AS VARCHAR), 2, '0')
       || lpad(CAST(m % 60 AS VARCHAR), 2, '0') AS timeid
FROM events, range(1440) AS r(m)"""),
    ("columninfo", _values(COLUMNS, ["columnid", "keyword", "columnName"])),
    ("devicetypeinfo", _values(DEVICES, ["devicetypeid", "deviceTypeName"])),
    ("refererhostinfo", _values(REFERERS, ["refererHostId", "url", "host"])),
    ("districtinfo", "SELECT n_nationkey AS districtid, n_name AS districtName FROM nation"),
    ("facts", """
SELECT cal.timeid, dis.districtid, ref.refererHostId AS refererhostid, dev.devicetypeid,
       col.columnid, l.ip, l.sessionid, l.daystr
FROM loginfo2 l
JOIN calendar cal ON substr(l.daystr, 1, 12) = cal.timeid
JOIN columninfo col ON l.columnName = col.keyword
JOIN devicetypeinfo dev ON l.deviceType = dev.deviceTypeName
JOIN districtinfo dis ON l.district = dis.districtName
JOIN refererhostinfo ref ON l.refererHost = ref.url"""),
    ("facts_uv", """
SELECT timeid, CAST(epoch(strptime(timeid, '%Y%m%d%H%M')) AS BIGINT) AS ts, sessionid,
       districtid, refererhostid, devicetypeid, columnid, daystr
FROM facts"""),
    ("visit_lag", """
SELECT *, lag(ts) OVER (PARTITION BY sessionid
                        ORDER BY ts, daystr, districtid, refererhostid, devicetypeid, columnid)
       AS fts
FROM facts_uv"""),
    ("visit_starts", """
SELECT timeid, ts, sessionid, districtid, refererhostid, devicetypeid, columnid
FROM visit_lag
WHERE fts IS NULL OR (ts - fts >= 1800 AND devicetypeid = 2)
   OR (ts - fts >= 300 AND devicetypeid = 1)"""),
    ("pv_day", """
SELECT substr(timeid, 1, 8) AS timeid, districtid, refererhostid, devicetypeid, columnid,
       count(*) AS pv
FROM facts GROUP BY 1, 2, 3, 4, 5"""),
    ("pv_hour", """
SELECT substr(timeid, 1, 10) AS timeid, districtid, refererhostid, devicetypeid, columnid,
       count(*) AS pv
FROM facts GROUP BY 1, 2, 3, 4, 5"""),
    ("uv_day", """
SELECT substr(timeid, 1, 8) AS timeid, sessionid, districtid, refererhostid, devicetypeid,
       columnid, count(*) AS uv
FROM visit_starts GROUP BY 1, 2, 3, 4, 5, 6"""),
    ("ip_day", """
SELECT DISTINCT substr(timeid, 1, 8) AS timeid, ip, districtid, refererhostid, devicetypeid,
       columnid
FROM facts"""),
    ("agent_dict", _values(DICTIONARY, ["userAgent", "deviceType"])),
]


def _cents(c: str) -> str:
    return f"CAST(({c}) // 100 AS VARCHAR) || '.' || lpad(CAST(({c}) % 100 AS VARCHAR), 2, '0')"


_OT = [_q(t) for t in ("produceOrderInfo", "order2")]
_PT = [_q(t) for t in ("producerOrderids", "pay2")]

def _orders_of(bus: str) -> str:
    return f"""
SELECT s[2] AS orderid, s[1] AS userid, s[4] AS ordertime,
       try_strptime(s[4], '%Y-%m-%d %H:%M:%S') AS order_ts
FROM (SELECT string_split(value, ',') AS s FROM {bus} WHERE topic IN ({', '.join(_OT)}))"""


def _payments_of(bus: str) -> str:
    return f"""
SELECT s[1] AS orderid, s[2] AS payment, s[3] AS paymenttime,
       try_strptime(s[3], '%Y-%m-%d %H:%M:%S') AS pay_ts
FROM (SELECT string_split(value, ',') AS s FROM {bus} WHERE topic IN ({', '.join(_PT)}))"""


def _batch_orders(rows: str) -> str:
    return f"""
SELECT s[2] AS orderid, s[1] AS userid, s[4] AS ordertime,
       try_strptime(s[4], '%Y-%m-%d %H:%M:%S') AS order_ts, batch
FROM (SELECT string_split(value, ',') AS s, batch FROM {rows} WHERE topic IN ({', '.join(_OT)}))"""


def _rounds(n: int) -> list[tuple[str, str]]:
    """Rounds of the looped query: the records of a part of the time, and what
    the round before has left open or waiting."""
    out = [("arrived", f"SELECT * EXCLUDE (batch), batch * {n} // segments AS batch FROM segmented"),
           ("arrived_orders", _batch_orders("arrived"))]
    for k in range(n):
        carried_o = (f"UNION ALL SELECT orderid, userid, ordertime, order_ts FROM looped{k - 1} "
                     "WHERE verdict = 'open'") if k else ""
        carried_p = f"UNION SELECT orderid FROM looped{k - 1} WHERE verdict = 'waiting'" if k else ""
        out.append((f"looped{k}", f"""
SELECT {k} AS batch, coalesce(o.orderid, p.orderid) AS orderid, userid, ordertime, order_ts,
  CASE WHEN o.orderid IS NULL THEN 'waiting' WHEN p.orderid IS NOT NULL THEN 'paid'
       WHEN order_ts IS NULL THEN 'rejected' WHEN order_ts + INTERVAL 5 MINUTE <
         (SELECT max("timestamp") FROM arrived WHERE batch = {k}) THEN 'remind' ELSE 'open' END AS verdict
FROM (SELECT DISTINCT ON (orderid) orderid, userid, ordertime, order_ts FROM (
        SELECT orderid, userid, ordertime, order_ts FROM arrived_orders WHERE batch = {k} {carried_o})
      ORDER BY orderid, order_ts NULLS LAST, userid, ordertime) o
FULL OUTER JOIN (SELECT DISTINCT string_split(value, ',')[1] AS orderid FROM arrived
                 WHERE batch = {k} AND topic IN ({', '.join(_PT)}) {carried_p}) p ON o.orderid = p.orderid"""))
    return out


def _status_of(orders: str, payments: str, at: str, any_payment: bool = False) -> str:
    """Order and payment rows side by side, ranked per order; one row each."""
    window = "true" if any_payment else (
        "coalesce(pay_ts BETWEEN order_ts - INTERVAL 10 MINUTE AND order_ts + INTERVAL 5 MINUTE, false)")
    return f"""
SELECT orderid, userid, ordertime, payment, paymenttime,
  CASE WHEN NOT has_order THEN 'orphan' WHEN settled THEN 'paid' WHEN order_ts IS NULL THEN 'untimed'
       WHEN timed THEN 'paid_late' WHEN has_payment THEN 'paid_untimed'
       WHEN order_ts + INTERVAL 5 MINUTE < {at} THEN 'remind' ELSE 'pending' END AS status
FROM (
  SELECT *, row_number() OVER (PARTITION BY orderid ORDER BY fits DESC, pay_ts NULLS LAST, payment,
                               paymenttime) AS place,
         bool_or(has_payment AND fits) OVER (PARTITION BY orderid) AS settled,
         bool_or(pay_ts IS NOT NULL) OVER (PARTITION BY orderid) AS timed
  FROM (
    SELECT coalesce(o.orderid, p.orderid) AS orderid, userid, ordertime, order_ts, payment, paymenttime,
           pay_ts, o.orderid IS NOT NULL AS has_order, p.orderid IS NOT NULL AS has_payment,
           o.orderid IS NOT NULL AND {window} AS fits
    FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY orderid
                           ORDER BY order_ts NULLS LAST, userid, ordertime) AS n FROM {orders}
            WHERE order_ts IS NULL OR order_ts <= {at}) WHERE n = 1) o
    FULL OUTER JOIN (SELECT * FROM {payments} WHERE pay_ts IS NULL OR pay_ts <= {at}) p
      ON o.orderid = p.orderid))
WHERE place = 1"""


CTES += [
    ("placed", """
SELECT *, o_orderdate + to_minutes(o_orderkey % 1440) AS placed FROM orders"""),
    ("orders_all", f"""
SELECT CASE WHEN o_orderstatus = 'P' THEN 'order2' ELSE 'produceOrderInfo' END AS topic,
       CAST(o_orderkey AS VARCHAR) AS orderid, o_orderkey AS order_no, placed AS event_ts,
       concat_ws(',', CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR),
                 'nation' || coalesce(CAST(c_nationkey AS VARCHAR), '?'),
                 CASE WHEN o_orderpriority = '5-LOW' AND o_orderkey % 10 = 0 THEN 'n/a'
                      ELSE strftime(placed, '%Y-%m-%d %H:%M:%S') END,
                 {_cents('goods')}, '0.00', {_cents('off')}, {_cents('goods - off')}) AS value,
       o_orderpriority = '1-URGENT' AND o_orderkey % 10 = 1 AS again
FROM (SELECT *, goods * coalesce(pct, 0) // 100 AS off
      FROM (SELECT *, CAST(floor(o_totalprice / 40) AS BIGINT) AS goods FROM placed)
      LEFT JOIN (SELECT l_orderkey, CAST(max(round(l_discount * 100)) AS BIGINT) AS pct
                 FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
      LEFT JOIN customer ON o_custkey = c_custkey)"""),
    ("orders_rec", """
SELECT topic, orderid, order_no, event_ts, value FROM orders_all
UNION ALL SELECT 'order2', orderid, order_no, event_ts + INTERVAL 1 DAY, value FROM orders_all WHERE again"""),
    ("payments_src", """
SELECT *, base + to_minutes(CAST(l_quantity AS INTEGER) - CASE l_returnflag WHEN 'A' THEN 20 ELSE 0 END) AS pay,
       CASE WHEN l_returnflag = 'R' THEN 'returned' ELSE '' END || CAST(l_orderkey AS VARCHAR) AS orderid
FROM (SELECT l.*, coalesce(placed, CAST(l_shipdate AS TIMESTAMP)) AS base,
             l_returnflag = 'N' AND l_linestatus = 'F' AS untimed
      FROM lineitem l LEFT JOIN placed ON l_orderkey = o_orderkey)"""),
    ("payments_rec", """
SELECT CASE WHEN l_returnflag = 'R' THEN 'pay2' ELSE 'producerOrderids' END AS topic, orderid,
       l_orderkey AS order_no, CASE WHEN untimed THEN base ELSE pay END AS event_ts,
       concat_ws(',', orderid, 'supplier' || CAST(l_suppkey AS VARCHAR),
                 CASE WHEN untimed THEN '' ELSE strftime(pay, '%Y-%m-%d %H:%M:%S') END,
                 CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR),
                 'line' || CAST(l_linenumber AS VARCHAR)) AS value
FROM payments_src"""),
    ("records", """
SELECT topic, CAST(order_no % 4 AS INTEGER) AS "partition", event_ts AS "timestamp", orderid AS "key", value
FROM (SELECT * FROM orders_rec UNION ALL SELECT * FROM payments_rec)"""),
    ("bus", """
SELECT *, row_number() OVER (PARTITION BY topic, "partition" ORDER BY "timestamp", "key", value) - 1 AS "offset"
FROM records"""),
    ("orders_b", _orders_of("bus")),
    ("payments_b", _payments_of("bus")),
    ("status_time", 'SELECT max("timestamp") AS moment FROM bus'),
    ("status", _status_of("orders_b", "payments_b", "(SELECT moment FROM status_time)")),
    ("carried", """
SELECT 'order2' AS topic, orderid AS "key", userid || ',' || orderid || ',nothing,' || ordertime AS value
FROM @status WHERE status = 'pending'
UNION ALL
SELECT 'pay2', orderid, orderid || ',' || payment || ',' || paymenttime FROM @status
WHERE status = 'orphan'""".replace("@status", "status")),
    ("segmented", """
SELECT *, CAST((sec - lo) * segments // (hi - lo + 1) AS BIGINT) AS batch
FROM (SELECT *, CAST(epoch("timestamp") AS BIGINT) AS sec FROM bus),
     (SELECT CAST(min(epoch("timestamp")) AS BIGINT) AS lo, CAST(max(epoch("timestamp")) AS BIGINT) AS hi,
             greatest(8, (count(*) + 99999) // 100000) AS segments FROM bus)"""),
    ("clocks", 'SELECT batch, max("timestamp") AS now FROM segmented GROUP BY 1'),
    ("segment_orders", _batch_orders("segmented")),
    ("first_orders", """
SELECT orderid, min(batch) AS bo, any_value(userid) AS userid, any_value(ordertime) AS ordertime,
       any_value(order_ts) AS order_ts FROM segment_orders GROUP BY 1"""),
    ("first_payments", f"""
SELECT string_split(value, ',')[1] AS orderid, min(batch) AS bp FROM segmented
WHERE topic IN ({', '.join(_PT)}) GROUP BY 1"""),
    # in which batch an order is due, and in which an order and a payment have met
    ("fates", """
SELECT o.*, p.bp, CASE WHEN bp IS NOT NULL THEN greatest(bo, bp) END AS paid,
       (SELECT min(batch) FROM clocks WHERE batch >= bo AND order_ts + INTERVAL 5 MINUTE < now) AS due
FROM first_orders o LEFT JOIN first_payments p USING (orderid)"""),
    ("stream_changes", """
SELECT bp AS batch, p.orderid, NULL AS userid, NULL AS ordertime, 'waiting' AS verdict
FROM first_payments p LEFT JOIN first_orders o USING (orderid) WHERE bo IS NULL OR bp < bo
UNION ALL
SELECT bo, orderid, userid, ordertime, CASE WHEN paid = bo THEN 'paid' WHEN order_ts IS NULL THEN 'rejected'
       WHEN due = bo THEN 'remind' ELSE 'open' END FROM fates
UNION ALL
SELECT least(paid, due), orderid, userid, ordertime, CASE WHEN paid <= coalesce(due, paid) THEN 'paid' ELSE 'remind' END
FROM fates WHERE order_ts IS NOT NULL AND coalesce(paid <> bo, true) AND coalesce(due <> bo, true)
  AND coalesce(paid, due) IS NOT NULL"""),
    *_rounds(3),
    ("positions", """
SELECT topic, "partition", count(*) AS n FROM bus GROUP BY 1, 2"""),
    ("history", """
SELECT p.topic, p."partition", b.batch_id, least(n, b.batch_id * 5000) AS from_offset,
       least(n, (b.batch_id + 1) * 5000) AS until_offset, t.batch_time
FROM positions p, (SELECT unnest(range((max(n) + 4999) // 5000)) AS batch_id FROM positions) b
LEFT JOIN (SELECT topic, "partition", "offset" // 5000 AS batch_id, max("timestamp") AS batch_time
           FROM bus GROUP BY 1, 2, 3) t
  ON t.topic = p.topic AND t."partition" = p."partition" AND t.batch_id = b.batch_id"""),
]


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the whole CTE library (unused CTEs cost nothing)."""
    return "WITH " + ",\n".join(f"{n} AS ({sql}\n)" for n, sql in CTES) + "\n" + body


_ROLLUP = {
    "device": ("devicetypeinfo", "devicetypeid", "devicetypeid", "deviceTypeName"),
    "column": ("columninfo", "columnid", "columnid", "columnName"),
    "referer": ("refererhostinfo", "refererhostid", "refererHostId", "host"),
    "district": ("districtinfo", "districtid", "districtid", "districtName"),
}


def _rollup(mart: str, dim: str, measure: str | None, out: str) -> str:
    table, mid, did, label = _ROLLUP[dim]
    agg = f"CAST(sum(m.{measure}) AS BIGINT)" if measure else "count(*)"
    return (f"SELECT m.timeid, d.{label}, {agg} AS {out} FROM {mart} m "
            f"JOIN {table} d ON m.{mid} = d.{did} GROUP BY 1, 2")


def _top3(mart: str, measure: str) -> str:
    return (f"SELECT * FROM (SELECT timeid, columnName, {measure}, CAST(row_number() OVER "
            f"(PARTITION BY timeid ORDER BY {measure} DESC, columnName ASC) AS INTEGER) AS rank "
            f"FROM ({_rollup(mart, 'column', measure, measure)})) WHERE rank <= 3")


_LOGINFO_COLS = ("ip, district, sessionid, datetime, daystr, url, status, sentBytes, "
                 "referal, userAgent")
_PARSED_COLS = ", ".join(ACCESS_LOG_FIELDS)

BODIES: dict[str, str] = {
    "log_text_scan": "SELECT value FROM lines",
    "ip_ranges_load": "SELECT start_ip, end_ip, district FROM ranges",
    "write_partitioned_overwrite": f"SELECT {_LOGINFO_COLS}, year, month, day FROM loginfo",
    "insert_overwrite_table": f"SELECT {_LOGINFO_COLS}, year, month, day FROM loginfo",
    "table_scan": "SELECT ip, district, sessionid, datetime, daystr, url, referal, userAgent "
                  "FROM loginfo",
    "write_table_overwrite": "SELECT * FROM pv_day",
    "row_count": "SELECT count(*) AS rows FROM loginfo",
    "preview": f"SELECT * FROM loginfo ORDER BY {_LOGINFO_COLS}, year, month, day LIMIT 20",
    "access_log_parse": "SELECT * FROM parsed",
    "access_log_parse_monthly": f"""
SELECT ip, '' AS district, sessionid, datetime, substr(replace(datetime, '-', ''), 1, 6) AS daystr,
       url, status, sentBytes, referal, userAgent,
       substr(replace(datetime, '-', ''), 1, 6) AS yearmonthday
FROM parsed""",
    "weblog_parse_typed": f"""
SELECT ip, sessionid, try_strptime(substr(time, 1, 19), '%Y-%m-%d %H:%M:%S') AS time, url, status,
       sentBytes, referer, userAgent
FROM (SELECT {_groups_sql('value', WEBLOG_STRICT, WEBLOG_FIELDS)}
      FROM lines WHERE regexp_full_match(value, {_q(WEBLOG_STRICT)}))""",
    "request_split_parse": f"""
SELECT {', '.join(f"g.{n}" for n in COMBINED_FIELDS)}
FROM (SELECT regexp_extract(value, {_q('^' + COMBINED_LOG + '$')},
                            [{', '.join(_q(n) for n in COMBINED_FIELDS)}]) AS g
      FROM combined_lines WHERE regexp_full_match(value, {_q(COMBINED_LOG)}))""",
    "parse_coverage": f"""
SELECT count(*) FILTER (WHERE m) AS matched, count(*) FILTER (WHERE NOT m) AS unmatched,
       count(*) FILTER (WHERE m AND try_strptime(substr(t, 1, 19), '%Y-%m-%d %H:%M:%S') IS NULL) AS bad_time
FROM (SELECT regexp_full_match(value, {_q(ACCESS_LOG)}) AS m,
             regexp_extract(value, {_q('^' + ACCESS_LOG + '$')}, 3) AS t FROM lines)""",
    "drop_error_status": f"""
SELECT {_PARSED_COLS} FROM parsed WHERE NOT regexp_matches(status, '^[45]\\d{{2}}$')""",
    "drop_static_resources": f"""
SELECT {_PARSED_COLS} FROM parsed
WHERE NOT (contains(url, '.css') OR contains(url, '.png') OR contains(url, '.jpg')
           OR contains(url, '.js') OR contains(url, '.ico') OR contains(url, '.gif'))""",
    "derive_daystr": "SELECT datetime, daystr, yearmonthday FROM parsed",
    "split_ymd_str": "SELECT yearmonthday, substr(yearmonthday, 1, 4) AS year, "
                     "substr(yearmonthday, 5, 2) AS month, substr(yearmonthday, 7) AS day "
                     "FROM parsed",
    "split_ymd_int": "SELECT daystr, TRY_CAST(substr(daystr, 1, 4) AS INTEGER) AS year, "
                     "TRY_CAST(substr(daystr, 5, 2) AS INTEGER) AS month, "
                     "TRY_CAST(substr(daystr, 7, 2) AS INTEGER) AS day FROM parsed",
    "ipv4_to_long": f"SELECT ip, {_ip2long('ip')} AS ip_long FROM parsed",
    "ip_to_district": "SELECT p.ip, d.district FROM parsed p JOIN ip_district d ON p.ip = d.ip",
    "ip_unresolved_audit": """
SELECT p.ip, count(*) AS lines FROM parsed p JOIN ip_district d ON p.ip = d.ip
WHERE district = 'unknown' GROUP BY 1""",
    "column_name": f"SELECT url, {_column_sql('url')} AS columnName FROM parsed",
    "referer_host": f"""
SELECT referal, {_referer_sql('referal')} AS refererHost
FROM (SELECT referal FROM parsed UNION ALL SELECT url AS referal FROM pages)""",
    "device_type": f"SELECT userAgent, {_device_sql('userAgent')} AS deviceType FROM parsed",
    "device_type_lookup": f"""
SELECT p.sessionid, p.userAgent, coalesce(d.deviceType, {_q(UNKNOWN)}) AS devicetype
FROM parsed p LEFT JOIN agent_dict d ON p.userAgent = d.userAgent""",
    "enrich_loginfo2": "SELECT * FROM loginfo2",
    "enrich_newloginfo": f"""
SELECT l.ip, l.district, l.sessionid, l.datetime, l.url, {_column_sql('l.url')} AS columnname,
       TRY_CAST(l.sentBytes AS INTEGER) AS sentBytes, l.referal,
       {_referer_sql('l.referal')} AS referalhost, l.userAgent,
       coalesce(d.deviceType, {_q(UNKNOWN)}) AS devicetype,
       substr(replace(l.datetime, '-', ''), 1, 8) AS yearmonthday
FROM loginfo l LEFT JOIN agent_dict d ON l.userAgent = d.userAgent""",
    "time_dimension": """
SELECT strftime(range, '%Y%m%d%H%M') AS timeid, strftime(range, '%Y') AS year,
       strftime(range, '%m') AS month, strftime(range, '%d') AS day,
       strftime(range, '%H') AS hour, strftime(range, '%M') AS minute
FROM (SELECT DISTINCT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day FROM events WHERE ts IS NOT NULL) d,
     range(d.day, d.day + INTERVAL 1 DAY, INTERVAL 1 MINUTE)""",
    "region_from_ip_json": """
SELECT ip, reply,
       CASE WHEN len(string_split(reply, ',')) < 3 THEN '0'
            ELSE json_extract_string(reply, '$.data.region') END AS region
FROM (
  SELECT ip, CASE WHEN district = 'unknown' THEN '{"code":1,"data":"invalid ip"}'
    ELSE '{"code":0,"data":{"ip":"' || ip || '","country":"XX","region":"' || '\\u'
         || lower(lpad(hex(ascii(district)), 4, '0')) || substr(district, 2)
         || '","isp":"\\u7535\\u4fe1"}}' END AS reply
  FROM (
    SELECT ip, district FROM ip_district))""",
    "star_join_pv": "SELECT timeid, districtid, refererhostid, devicetypeid, columnid FROM facts",
    "star_join_ip": "SELECT timeid, ip, districtid, refererhostid, devicetypeid, columnid "
                    "FROM facts",
    "star_join_uv": "SELECT timeid, ts, sessionid, districtid, refererhostid, devicetypeid, "
                    "columnid FROM facts_uv",
    "pv_mart_day": "SELECT * FROM pv_day",
    "pv_mart_hour": "SELECT * FROM pv_hour",
    "ip_mart_day": "SELECT * FROM ip_day",
    "visit_starts": "SELECT * FROM visit_starts",
    "uv_mart_day": "SELECT * FROM uv_day",
    "uv_mart_day_by_days": "SELECT * FROM uv_day",
    "ip_day_total": "SELECT timeid, count(ip) AS ips FROM ip_day GROUP BY 1",
    "ip_day_total_exact": "SELECT timeid, count(DISTINCT ip) AS ips FROM ip_day GROUP BY 1",
    "top3_columns_pv_day": _top3("pv_day", "pv"),
    "top3_columns_pv_hour": _top3("pv_hour", "pv"),
    "top3_columns_uv_day": _top3("uv_day", "uv"),
}

for _dim in ("device", "column", "referer", "district"):
    BODIES[f"pv_day_by_{_dim}"] = _rollup("pv_day", _dim, "pv", "pv")
    BODIES[f"pv_hour_by_{_dim}"] = _rollup("pv_hour", _dim, "pv", "pv")
    BODIES[f"uv_day_by_{_dim}"] = _rollup("uv_day", _dim, "uv", "uv")
    BODIES[f"ip_day_by_{_dim}"] = _rollup("ip_day", _dim, None, "ips")


BODIES.update({
    "order_record_parse": "SELECT " + ", ".join(
        f"s[{i + 1}] AS {n}" for i, n in enumerate(
            ["userId", "orderid", "addressId", "ordertime", "goodsamount", "carriage",
             "discountamount", "amount"]))
        + f" FROM (SELECT string_split(value, ',') AS s FROM bus WHERE topic IN ({', '.join(_OT)}))",
    "payment_record_parse": "SELECT " + ", ".join(
        f"s[{i + 1}] AS {n}" for i, n in enumerate(
            ["orderid", "payment", "paymenttime", "bonus", "paymenttype"]))
        + f" FROM (SELECT string_split(value, ',') AS s FROM bus WHERE topic IN ({', '.join(_PT)}))",
    "delivery_record_parse": """
SELECT CAST(c_custkey AS VARCHAR) AS userId, 'nation' || CAST(c_nationkey AS VARCHAR) AS addressId,
       c_mktsegment AS address, c_name AS linkman,
       CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) AS VARCHAR) AS phonenum FROM customer""",
    "order_topic_route": f"""
SELECT CASE WHEN topic IN ({', '.join(_OT)}) THEN 'order' ELSE 'payment' END AS stream,
       topic, "partition", "offset", "key"
FROM bus WHERE topic IN ({', '.join(_OT + _PT)})""",
    "orders_payments_full_outer": """
SELECT coalesce(o.orderid, p.orderid) AS orderid, o.userid, o.ordertime, p.payment, p.paymenttime
FROM orders_b o FULL OUTER JOIN payments_b p ON o.orderid = p.orderid""",
    **dict.fromkeys(("orders_payments_bucketed", "orders_payments_salted"), """
SELECT coalesce(o.orderid, p.orderid) AS orderid, o.userid, o.ordertime, p.payment, p.paymenttime
FROM orders_b o FULL OUTER JOIN payments_b p ON o.orderid = p.orderid"""),
    "order_payment_status": "SELECT * FROM status",
    "order_payment_status_any_payment": _status_of("orders_b", "payments_b", "(SELECT moment FROM status_time)", any_payment=True),
    "carry_forward": "SELECT * FROM carried",
    "carry_forward_stream": "SELECT * FROM carried",
    "order_amounts": """
SELECT orderid, g AS goodsamount, c AS carriage, d AS discountamount, round(g + c - d, 2) AS amount
FROM (SELECT orderid, g, d, CAST(CASE WHEN g < 48 THEN 10 WHEN g < 98 THEN 5 ELSE 0 END AS DOUBLE) AS c
      FROM (SELECT s[2] AS orderid, TRY_CAST(s[5] AS DOUBLE) AS g, TRY_CAST(s[7] AS DOUBLE) AS d
            FROM (SELECT string_split(value, ',') AS s FROM bus
                  WHERE topic IN (""" + ", ".join(_OT) + """))))""",
    "time_interval_seconds": """
SELECT o.orderid, o.ordertime, p.paymenttime, date_diff('second', o.order_ts, p.pay_ts) AS seconds
FROM orders_b o JOIN payments_b p ON o.orderid = p.orderid""",
    "order_stream_source": 'SELECT topic, "partition", "offset", "timestamp", "key", value FROM bus',
    "unpaid_orders_stream": """
SELECT orderid, userid, ordertime FROM stream_changes WHERE verdict = 'remind'""",
    "stream_batch_offsets": """
SELECT batch_id, topic, "partition", from_offset, until_offset, until_offset - from_offset AS records
FROM history""",
    "pending_sink": "\nUNION ALL\n".join(
        f"SELECT batch, orderid, userid, ordertime, verdict FROM looped{k}" for k in range(3)),
    "batch_record_count": """
SELECT batch_id, CAST(sum(until_offset - from_offset) AS BIGINT) AS records FROM history GROUP BY 1""",
    "micro_batch_trigger": """
SELECT batch, verdict, count(*) AS records FROM stream_changes GROUP BY 1, 2""",
    "offset_history_append": """
SELECT 'reminders' AS "group", topic, "partition", batch_id, batch_time, until_offset FROM history""",
    "batch_offset_report": """
SELECT batch_id, topic, count(*) FILTER (until_offset > from_offset) AS partitions,
       CAST(sum(until_offset - from_offset) AS BIGINT) AS offsets,
       CAST(sum(sum(until_offset - from_offset)) OVER (PARTITION BY batch_id) AS BIGINT) AS records
FROM history GROUP BY 1, 2""",
    "offset_latest_lookup": """
SELECT topic, "partition", least(n, 10000) AS "offset" FROM positions""",
    "starting_offsets_resolve": """
SELECT topic, "partition", CASE WHEN topic = 'pay2' THEN 0 ELSE least(n, 10000) END AS "offset" FROM positions""",
})


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(body) for name, body in BODIES.items()}
