"""Connected components of a link table, by alternating large and small stars.

Each round links every node to the least node it knows of, until only stars
are left.  Rounds are few (logarithmic in the longest path), each cut by a
stored table.  Minima are aggregated partially and joined back between stored
tables, where adaptive execution splits the rows of a hub.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import stored


def local_components(n: int, pairs) -> np.ndarray:
    """Least member of each of ``n`` nodes' components; ``pairs`` yields
    arrays of linked nodes ``(a, b)``."""
    label = np.arange(n)
    for a, b in pairs:
        while True:
            la, lb = label[a], label[b]
            apart = la != lb
            if not apart.any():
                break
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
    return label


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) \
        if large else edges
    least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "star_min")
    at = both.join(least, "u")
    if large:
        # neighbours above the node move to its least neighbour
        out = at.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        # the node and its smaller neighbours move to the least one
        out = at.select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
    return stored(out.where(F.col("u") > F.col("v")).distinct(), "star")


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links (u, v)`` that is not the
    least of its component; no links give no rows.  Repeated links, self
    links and either direction are accepted."""
    edges = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .where(F.col("u") != F.col("v")).distinct(), "links")
    before = None
    while (now := _state(edges)) != before and now[0]:
        before = now
        edges = _star(_star(edges, large=True), large=False)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
