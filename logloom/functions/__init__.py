"""Column builders and line parsers (built-in Spark SQL functions only)."""

from logloom.functions.columns import (
    carriage, column_name, daystr, device_type, ipv4_to_long, is_error_status,
    is_static_resource, is_static_resource_substring, log_time, long_to_ipv4,
    order_amount, referer_host, region_from_ip_json, split_ymd_int,
    split_ymd_str, time_interval_seconds, yearmonth, yearmonthday,
)
from logloom.functions.parse import (
    access_log_parse, access_log_parse_monthly, csv_fields, parse_coverage,
    request_split_parse, weblog_parse_typed,
)

__all__ = [
    "access_log_parse", "access_log_parse_monthly", "carriage", "column_name",
    "csv_fields", "daystr", "device_type", "ipv4_to_long", "is_error_status",
    "is_static_resource", "is_static_resource_substring", "log_time",
    "long_to_ipv4", "order_amount", "parse_coverage", "referer_host",
    "region_from_ip_json", "request_split_parse",
    "split_ymd_int", "split_ymd_str", "time_interval_seconds",
    "weblog_parse_typed", "yearmonth", "yearmonthday",
]
