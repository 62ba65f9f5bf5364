"""DataFrame-level operators."""

from logloom.operators.dims import time_dimension, time_dimension_of
from logloom.operators.enrich import device_type_lookup, enrich_loginfo2, enrich_newloginfo
from logloom.operators.filters import drop_error_status, drop_static_resources
from logloom.operators.geo import bucketed_ranges, ip_to_district, ip_unresolved_audit
from logloom.operators.marts import ip_mart, pv_mart, uv_mart, visit_starts
from logloom.operators.offsets import (
    offset_latest_lookup, starting_offsets_json, starting_offsets_resolve,
)
from logloom.operators.orders import (
    carry_forward, order_amounts, order_payment_status, orders_payments_full_outer, route_topics,
)
from logloom.operators.reports import ip_day_total, rollup_by, top_n
from logloom.operators.star import star_join, star_join_ip, star_join_pv, star_join_uv

__all__ = [
    "bucketed_ranges", "carry_forward",
    "device_type_lookup", "drop_error_status", "drop_static_resources",
    "enrich_loginfo2", "enrich_newloginfo", "ip_day_total", "ip_mart", "ip_to_district",
    "ip_unresolved_audit", "offset_latest_lookup", "order_amounts",
    "order_payment_status", "orders_payments_full_outer",
    "pv_mart", "rollup_by", "route_topics",
    "star_join", "star_join_ip", "star_join_pv", "star_join_uv", "starting_offsets_json",
    "starting_offsets_resolve", "time_dimension", "time_dimension_of", "top_n",
    "uv_mart", "visit_starts",
]
