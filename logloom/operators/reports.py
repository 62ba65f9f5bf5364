"""Roll-ups of the marts by one dimension, and top-N per time key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# dimension name -> (mart id column, dimension id column, label column)
ROLLUP_DIMS = {
    "device": ("devicetypeid", "devicetypeid", "deviceTypeName"),
    "column": ("columnid", "columnid", "columnName"),
    "referer": ("refererhostid", "refererHostId", "host"),
    "district": ("districtid", "districtid", "districtName"),
}


def dimension_for(dims, name: str) -> DataFrame:
    return {"device": dims.devices, "column": dims.columns,
            "referer": dims.referers, "district": dims.districts}[name]


def rollup_by(mart: DataFrame, dim: DataFrame, name: str, measure: str | None,
              out_col: str) -> DataFrame:
    """Join the mart to one dimension (id -> label) and aggregate per
    (timeid, label): ``sum(measure)``, or ``count(*)`` when measure is None.

    The mart is already aggregated, so this is a small shuffle; the
    dimension is joined by a broadcast lookup.
    """
    mart_id, dim_id, label = ROLLUP_DIMS[name]
    d = dim.select(F.col(dim_id).alias("_dim_id"), label)
    joined = mart.join(d, mart[mart_id] == d["_dim_id"])
    agg = (F.sum(measure) if measure else F.count(F.lit(1))).alias(out_col)
    return joined.groupBy("timeid", label).agg(agg)


def top_n(df: DataFrame, partition_col: str, order_col: str, n: int,
          tie_cols: list[str], rank_col: str = "rank") -> DataFrame:
    """``row_number() over (partition by p order by measure desc, ties)`` <= n.

    A filter on ``row_number`` lets the planner insert a per-partition
    group limit before the shuffle, so at most n rows per key move.
    """
    w = Window.partitionBy(partition_col).orderBy(
        F.col(order_col).desc(), *[F.col(c).asc() for c in tie_cols])
    return (df.withColumn(rank_col, F.row_number().over(w))
            .where(F.col(rank_col) <= n))


def ip_day_total(ip_mart: DataFrame, exact: bool = False) -> DataFrame:
    """IPs per day.  Default counts mart rows (ip x dimension combinations),
    as the reference does; ``exact=True`` counts distinct IPs."""
    agg = F.count_distinct("ip") if exact else F.count("ip")
    return ip_mart.groupBy("timeid").agg(agg.alias("ips"))
