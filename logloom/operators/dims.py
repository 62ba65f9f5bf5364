"""Calendar (time) dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MINUTES_PER_DAY = 1440


def _calendar_columns(ts: Column) -> list[Column]:
    return [F.date_format(ts, "yyyyMMddHHmm").alias("timeid"),
            F.date_format(ts, "yyyy").alias("year"),
            F.date_format(ts, "MM").alias("month"),
            F.date_format(ts, "dd").alias("day"),
            F.date_format(ts, "HH").alias("hour"),
            F.date_format(ts, "mm").alias("minute")]


def time_dimension(spark: SparkSession, start_day: str, n_days: int) -> DataFrame:
    """Minute-grain calendar: timeid (``yyyyMMddHHmm``), year .. minute.

    Built from ``spark.range`` so Catalyst knows its exact row count (and
    so its broadcast size) without running anything.
    """
    start = F.lit(start_day).cast("timestamp_ntz")
    minutes = spark.range(n_days * MINUTES_PER_DAY)
    ts = F.timestamp_add("MINUTE", F.col("id"), start)
    return minutes.select(*_calendar_columns(ts))


def time_dimension_of(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Calendar of the days that occur in ``ts_col``, all minutes of each.

    Days are made distinct on the map side, so the shuffle holds a row per day
    and task.  A far-off timestamp adds its own day and nothing else; a null
    one adds none.
    """
    days = df.select(F.to_date(ts_col).alias("_day")).where(F.col("_day").isNotNull()).distinct()
    minutes = days.select("_day", F.explode(F.sequence(F.lit(0), F.lit(MINUTES_PER_DAY - 1))).alias("_minute"))
    ts = F.timestamp_add("MINUTE", F.col("_minute"), F.col("_day").cast("timestamp_ntz"))
    return minutes.select(*_calendar_columns(ts))
