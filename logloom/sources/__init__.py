"""Readers, and the inputs derived from the warehouse tables."""

from logloom.sources.text import ip_ranges_from_lines, ip_ranges_load, log_text_scan, table_scan

__all__ = ["ip_ranges_from_lines", "ip_ranges_load", "log_text_scan", "table_scan"]
