"""Row-level column builders.

Every function returns a ``Column`` made of built-in Spark SQL functions,
so the rules run inside whole-stage code generation; no Python UDF is
involved anywhere in the engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Labels and keyword lists that must equal the reference's for
# identical results.  Kept verbatim and in their natural order.
# ---------------------------------------------------------------------------
DEVICE_MOBILE = "移动端"          # mobile
DEVICE_PC = "PC端"               # desktop
DEVICE_MONITOR = "域名监控"       # domain monitor
DEVICE_UNKNOWN = "unknown"
MOBILE_AGENT_KEYWORDS = ["android", "windows phone", "iphone", "ipad", "ipod"]
PC_AGENT_KEYWORD = "windows nt"
MONITOR_AGENT_KEYWORD = "DNSPod-Monitor/1.0"
STATIC_RESOURCE_EXTENSIONS = ["css", "png", "jpg", "js", "ico", "gif"]
UNKNOWN_DISTRICT = "unknown"
NO_REFERER_HOST = "-"
# carriage tiers of an order: goods amount below 48 -> 10, below 98 -> 5, else 0
CARRIAGE_TIERS = [(48, 10.0), (98, 5.0)]
CARRIAGE_DEFAULT = 0.0
# ---------------------------------------------------------------------------


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ipv4_to_long(ip: str | Column) -> Column:
    """Dotted quad -> 32-bit value in a BIGINT (``54.32.33.14`` -> 908075278).

    Octets are combined with shift-left / bitwise-or, exactly like the
    reference's fold, so out-of-range octets give the same bits it gives.
    Anything that is not four numeric octets maps to NULL (the reference
    throws).  Four ``split_part`` calls keep this in generated code (array
    lambdas would be interpreted per row).
    """
    s = _c(ip)
    octets = [F.split_part(s, F.lit("."), F.lit(i)).try_cast("bigint") for i in (1, 2, 3, 4)]
    dots = F.length(s) - F.length(F.translate(s, ".", ""))
    valid = dots == 3
    for o in octets:
        valid = valid & o.isNotNull()
    value = (F.shiftleft(octets[0], 24).bitwiseOR(F.shiftleft(octets[1], 16))
             .bitwiseOR(F.shiftleft(octets[2], 8)).bitwiseOR(octets[3]))
    return F.when(valid, value)


def long_to_ipv4(value: str | Column) -> Column:
    """Inverse of :func:`ipv4_to_long` for values in [0, 2^32)."""
    v = _c(value)
    return F.concat_ws(".", *[F.shiftright(v, s).bitwiseAND(255).cast("string")
                              for s in (24, 16, 8, 0)])


def is_error_status(status: str | Column) -> Column:
    """True for 4xx / 5xx status strings (three characters, first 4 or 5)."""
    return _c(status).rlike(r"^[45]\d{2}$")


def is_static_resource(request: str | Column) -> Column:
    """True when the request mentions a static-resource extension anywhere.

    Case-sensitive and unanchored, as in the reference: ``/a.json`` and
    ``/a.jsp`` count (they contain ``.js``), ``/a.JPG`` does not.
    """
    alternation = "|".join(STATIC_RESOURCE_EXTENSIONS)
    return _c(request).rlike(rf"\.({alternation})")


def is_static_resource_substring(request: str | Column) -> Column:
    """Substring form of :func:`is_static_resource` (no regex)."""
    r = _c(request)
    cond = F.lit(False)
    for ext in STATIC_RESOURCE_EXTENSIONS:
        cond = cond | r.contains("." + ext)
    return cond


def daystr(datetime: str | Column) -> Column:
    """``2017-01-08 00:38:04 +0800`` -> ``20170108003804``."""
    return F.substring(F.translate(_c(datetime), "- :", ""), 1, 14)


def yearmonthday(datetime: str | Column) -> Column:
    """First 8 characters after removing dashes (the partition key)."""
    return F.substring(F.translate(_c(datetime), "-", ""), 1, 8)


def yearmonth(datetime: str | Column) -> Column:
    """First 6 characters after removing dashes (monthly partition key)."""
    return F.substring(F.translate(_c(datetime), "-", ""), 1, 6)


def split_ymd_str(ymd: str | Column) -> tuple[Column, Column, Column]:
    """``yyyyMMdd`` -> ('yyyy', 'MM', 'dd...') as strings (zero-padded)."""
    s = _c(ymd)
    # the day is "everything from the 7th character on", like substring(6)
    return (F.substring(s, 1, 4), F.substring(s, 5, 2),
            s.substr(F.lit(7), F.length(s)))


def split_ymd_int(day_string: str | Column) -> tuple[Column, Column, Column]:
    """``yyyyMMdd...`` -> (year, month, day) as integers."""
    s = _c(day_string)
    return (F.substring(s, 1, 4).try_cast("int"),
            F.substring(s, 5, 2).try_cast("int"),
            F.substring(s, 7, 2).try_cast("int"))


def column_name(request: str | Column) -> Column:
    """Site column of a request line: first path segment up to the first dot.

    Only requests with exactly three whitespace-separated tokens qualify
    (``GET /a/b.html HTTP/1.1`` -> ``a``); anything else gives ``''``.
    Inputs on which the reference throws (``/``, ``/.``, ``*``, double
    spaces) give ``''`` here.  Trailing blanks are removed before counting
    tokens because Java's split drops trailing empty strings.
    """
    r = _c(request)
    n_tokens = F.size(F.split(F.regexp_replace(r, r"\s+$", ""), r"\s+"))
    target = F.split_part(r, F.lit(" "), F.lit(2))
    segment = F.split_part(target, F.lit("/"), F.lit(2))
    return F.when(n_tokens == 3,
                  F.split_part(segment, F.lit("."), F.lit(1))).otherwise("")


def referer_host(referer: str | Column) -> Column:
    """Third '/'-separated field of the referer (the host), else ``'-'``."""
    parts = F.split(F.regexp_replace(_c(referer), "/+$", ""), "/")
    return F.when(F.size(parts) >= 3, F.get(parts, 2)).otherwise(NO_REFERER_HOST)


def device_type(agent: str | Column, fix_monitor_rule: bool = False) -> Column:
    """Device class from user-agent keywords: mobile, then PC, then monitor.

    The reference tests the monitor keyword (mixed case) against the
    lower-cased agent, so that branch never fires; ``fix_monitor_rule=True``
    compares case-insensitively instead.
    """
    low = F.lower(_c(agent))
    mobile = F.lit(False)
    for kw in MOBILE_AGENT_KEYWORDS:
        mobile = mobile | low.contains(kw)
    monitor_kw = MONITOR_AGENT_KEYWORD.lower() if fix_monitor_rule else MONITOR_AGENT_KEYWORD
    return (F.when(mobile, DEVICE_MOBILE)
            .when(low.contains(PC_AGENT_KEYWORD), DEVICE_PC)
            .when(low.contains(monitor_kw), DEVICE_MONITOR)
            .otherwise(DEVICE_UNKNOWN))


def log_time(datetime: str | Column, fmt: str = "yyyy-MM-dd HH:mm:ss Z") -> Column:
    """Parse a log time string to TIMESTAMP_NTZ, keeping the wall-clock time.

    The zone offset is dropped, as ``LocalDateTime.parse`` does.  Strings
    that do not parse give NULL instead of failing the job.
    """
    s = _c(datetime)
    if fmt.endswith(" Z"):
        s, fmt = F.substring(s, 1, 19), fmt[:-2]
    at = F.try_to_timestamp(s, F.lit(fmt)).cast("timestamp_ntz")
    if fmt == "yyyy-MM-dd HH:mm:ss":
        # nothing shorter can be such a time: the parser would raise, and drop, an
        # exception for each empty field
        at = F.when(F.length(s) >= 19, at)
    return at


def time_interval_seconds(later: str | Column, earlier: str | Column,
                          fmt: str = "yyyy-MM-dd HH:mm:ss Z") -> Column:
    """Whole wall-clock seconds between two time strings (``later - earlier``)."""
    return F.timestamp_diff("SECOND", log_time(earlier, fmt), log_time(later, fmt))


def region_from_ip_json(reply: str | Column) -> Column:
    """``data.region`` of a geo-IP JSON reply; ``\\uXXXX`` escapes decoded.

    A reply with fewer than three comma-separated fields is an invalid-IP
    answer and yields ``'0'``, as in the reference.
    """
    r = _c(reply)
    return F.when(F.size(F.split(r, ",")) < 3, F.lit("0")).otherwise(
        F.get_json_object(r, "$.data.region"))


def carriage(goods_amount: str | Column) -> Column:
    """Shipping charge tier of an order."""
    g = _c(goods_amount)
    expr = None
    for bound, fee in CARRIAGE_TIERS:
        expr = (F.when(g < bound, F.lit(fee)) if expr is None
                else expr.when(g < bound, F.lit(fee)))
    return expr.otherwise(F.lit(CARRIAGE_DEFAULT))


def order_amount(goods_amount: str | Column, discount: str | Column) -> Column:
    """Amount due = goods + carriage - discount, rounded to cents."""
    return F.round(_c(goods_amount) + carriage(goods_amount) - _c(discount), 2)
