"""Access-log line parsers, in time linear in the line.

The line patterns are sequences of greedy groups, so a backtracking engine may
try every combination of their delimiters on a near-miss line.  But the
delimiters are settled from the right: a longer group to the left never makes
the rest impossible that a shorter one allows, so each greedy group ends at the
last delimiter that leaves room for what was settled behind it.  One search per
delimiter, from the right, finds the captures of the pattern; no step goes back
on another.  ``tests/test_parse_property.py`` holds the parsers against the
patterns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions import columns as C

# ---------------------------------------------------------------------------
# The line patterns of the reference (unanchored there because
# Java's ``matches()`` anchors them; anchored with ^...\z here).
# ---------------------------------------------------------------------------
# ip session [datetime] "request" status bytes "referer" "agent"
ACCESS_LOG_PATTERN = r'(\S+) (.+) \[(.+)\] "(.*)" (\d+) (\d+) "(.*)" "(.*)"'
# stricter typed reader: one-token session, three-token request, no-space referer
WEBLOG_STRICT_PATTERN = r'(\S+) (\S+) \[(.+)\] "(\S+ \S+ \S+)" (\d+) (\d+) "(\S+)" "(.+)"'
# combined log format with the request split into method, target, protocol
COMBINED_LOG_PATTERN = r'(\S+) (.+) \[(.+)\] "(\S+) (\S+) (\S+)" (\d+) (\d+) "(\S+)" "(.+)"'
# ---------------------------------------------------------------------------

ACCESS_LOG_FIELDS = ["ip", "sessionid", "datetime", "url", "status",
                     "sentBytes", "referal", "userAgent"]
WEBLOG_FIELDS = ["ip", "sessionid", "time", "url", "status", "sentBytes",
                 "referer", "userAgent"]
COMBINED_LOG_FIELDS = ["ip", "identity", "datetime", "method", "target",
                       "protocol", "status", "sentBytes", "referer", "userAgent"]

_SEP = "\n"
#: What "." matches: all but line terminators.
_ANY = r"[^\n\r\u0085\u2028\u2029]"
#: Steps of a parser: each finds one delimiter that repeats, from the right, and
#: puts line ends between the parts.  A step looks at the first part of the
#: step before, and first whether there is one: a search that cannot end well
#: is not begun.  Tokens that end at a space need no search.
_PARTED = r"(?s)^(?=[^\n]*+\n)"
_ACCESS_STEPS = [
    (rf'^(\S++ {_ANY}*)" "({_ANY}*)"\z', 2),                                # ... | agent
    (_PARTED + r'([^\n]*)" (\d++) (\d++) "([^\n]*\n.*)\z', 4),             # ... | status | bytes | referer
    (_PARTED + r'([^\n]*)\] "([^\n]*\n.*)\z', 2),                          # ... | request
    (_PARTED + r'(\S++) ([^\n]+) \[([^\n]+\n.*)\z', 3)]                    # ip | session | datetime
_COMBINED_STEPS = [
    (rf'^(\S++ {_ANY}+)\] "(\S++) (\S++) (\S+)" (\d++) (\d++) "(\S+)" "({_ANY}+)"\z', 8),
    _ACCESS_STEPS[-1]]
_STRICT_STEPS = [
    (rf'^(\S++) (\S++) \[({_ANY}+)\] "(\S++ \S++ \S+)" (\d++) (\d++) "(\S+)" "({_ANY}+)"\z', 8)]
#: Most lines have no quote or bracket but the delimiters: there is nothing to
#: search in them, and one step without a choice gives all parts.
_PLAIN_FRONT = r'^(?=\S++ .*+\z)(\S++) ([^"\[\]]+) \[([^"\[\]]++)\] '
_ACCESS_PLAIN = (_PLAIN_FRONT + r'"([^"]*+)" (\d++) (\d++) "([^"]*+)" "([^"]*+)"\z', 8)
_COMBINED_PLAIN = (_PLAIN_FRONT + r'"([^\s"]++) ([^\s"]++) ([^\s"]++)" (\d++) (\d++) "([^\s"]++)" "([^"]++)"\z', 10)
_PLAIN_STEP = {ACCESS_LOG_PATTERN: _ACCESS_PLAIN, COMBINED_LOG_PATTERN: _COMBINED_PLAIN}
_STEPS = {ACCESS_LOG_PATTERN: _ACCESS_STEPS, COMBINED_LOG_PATTERN: _COMBINED_STEPS,
          WEBLOG_STRICT_PATTERN: _STRICT_STEPS}


def _staged(lines: DataFrame, pattern: str, value_col: str, keep: list[str]) -> DataFrame:
    """``keep``, ``_f`` (the captured groups) and ``_m`` (whether the line matches).

    A step that finds nothing leaves its text as it was, so a line matches iff
    it ends up in as many parts as all steps make; a line with a line end of
    its own matches no pattern.

    The result stands behind a one-row ``inline``.  Catalyst pushes later
    filters (status, static resources) through plain projections by
    substituting the projected expression, which would parse again inside
    every pushed predicate; a generator's output cannot be substituted, so the
    line is parsed once, inside whole-stage code generation.
    """
    def parted(text, step: str, groups: int):
        return F.regexp_replace(text, step, _SEP.join(f"${i}" for i in range(1, groups + 1)))
    value = F.col(value_col)
    line = F.when(value.endswith('"') & ~value.contains(_SEP), value)
    if pattern in _PLAIN_STEP:
        line = parted(line, *_PLAIN_STEP[pattern])
    lines = lines.select(*keep, line.alias("_line"))
    text, parts = F.col("_line"), 1
    for step, groups in _STEPS[pattern]:
        text = parted(text, step, groups)
        parts += groups - 1
    text = F.when(F.contains("_line", F.lit(_SEP)), F.col("_line")).otherwise(text)
    staged = lines.select(*keep, F.inline(F.array(F.struct(F.split(text, _SEP).alias("_f")))))
    return staged.select(*keep, "_f", F.coalesce(F.size("_f") == parts, F.lit(False)).alias("_m"))


def _parse(lines: DataFrame, pattern: str, names: list[str],
           value_col: str, keep: list[str] | None = None) -> DataFrame:
    """The groups of the lines that match the pattern, as columns ``names``."""
    keep = keep or []
    # get() (NULL when out of range) rather than [i]: Catalyst may evaluate a
    # predicate on a field before the "_m" check
    return _staged(lines, pattern, value_col, keep).where("_m").select(
        *keep, *[F.get(F.col("_f"), i).alias(n) for i, n in enumerate(names)])


def access_log_parse(lines: DataFrame, value_col: str = "value",
                     keep: list[str] | None = None) -> DataFrame:
    """Parse access-log lines; lines that do not match produce no row.

    Output: ip, sessionid, datetime, url, status, sentBytes, referal,
    userAgent, daystr (``yyyyMMddHHmmss``), yearmonthday (``yyyyMMdd``).
    """
    parsed = _parse(lines, ACCESS_LOG_PATTERN, ACCESS_LOG_FIELDS, value_col, keep)
    return parsed.withColumns({
        "daystr": C.daystr("datetime"),
        "yearmonthday": C.yearmonthday("datetime"),
    })


def access_log_parse_monthly(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Variant without IP lookup: district ``''``; daystr = month key."""
    parsed = _parse(lines, ACCESS_LOG_PATTERN, ACCESS_LOG_FIELDS, value_col)
    ym = C.yearmonth("datetime")
    return parsed.select("ip", F.lit("").alias("district"), "sessionid",
                         "datetime", ym.alias("daystr"), "url", "status",
                         "sentBytes", "referal", "userAgent",
                         ym.alias("yearmonthday"))


def weblog_parse_typed(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Strict reader; ``time`` becomes a TIMESTAMP_NTZ (zone dropped).

    A line whose time does not parse gets a NULL time instead of failing
    the job.
    """
    parsed = _parse(lines, WEBLOG_STRICT_PATTERN, WEBLOG_FIELDS, value_col)
    return parsed.withColumn("time", C.log_time("time"))


def request_split_parse(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Combined-log reader with method / target / protocol as groups."""
    return _parse(lines, COMBINED_LOG_PATTERN, COMBINED_LOG_FIELDS, value_col)


def parse_coverage(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Line counts (one row): matched, unmatched, and ``bad_time``, the matched
    lines whose time cannot be read (their date parts are garbage)."""
    staged = _staged(lines, ACCESS_LOG_PATTERN, value_col, [])
    time = C.log_time(F.get(F.col("_f"), ACCESS_LOG_FIELDS.index("datetime")))
    return staged.agg(
        F.count_if(F.col("_m")).alias("matched"),
        F.count_if(~F.col("_m")).alias("unmatched"),
        F.count_if(F.col("_m") & time.isNull()).alias("bad_time"))


def csv_fields(value: str | Column, names: list[str]) -> list[Column]:
    """Split a comma-separated record into named string columns.

    Missing trailing fields become NULL (``try_element_at``) rather than
    raising under ANSI mode.
    """
    v = F.col(value) if isinstance(value, str) else value
    parts = F.split(v, ",")
    return [F.try_element_at(parts, F.lit(i + 1)).alias(n) for i, n in enumerate(names)]
