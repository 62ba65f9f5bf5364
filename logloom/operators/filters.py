"""Row filters of the ETL stage."""

from __future__ import annotations

from pyspark.sql import DataFrame

from logloom.functions.columns import is_error_status, is_static_resource


def drop_error_status(df: DataFrame, status_col: str = "status") -> DataFrame:
    """Drop 4xx / 5xx responses."""
    return df.where(~is_error_status(status_col))


def drop_static_resources(df: DataFrame, request_col: str = "url") -> DataFrame:
    """Drop requests for static resources (.css .png .jpg .js .ico .gif)."""
    return df.where(~is_static_resource(request_col))
