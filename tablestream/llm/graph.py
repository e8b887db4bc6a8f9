"""Connected components of an edge table by alternating large and small stars.

Every step is a grouping and a join; nothing about a component is gathered in one place. Each
round is stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablestream.llm.common import plain_plans, stored


def _linked(edges: DataFrame, smaller_only: bool) -> DataFrame:
    """Link each neighbour of a node (only the smaller ones, or only the larger) to the least one."""
    if smaller_only:
        near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    least = stored(near.groupBy("u").agg(F.min("v").alias("m")))
    least = least.select(F.col("u"), F.least("u", "m").alias("m"))
    joined = near.join(least, "u")
    if smaller_only:
        moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b"))
        out = moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        out = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return stored(out.filter("a != b").distinct())


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    ).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``id``, ``component`` (least id reachable) for every node of edges ``a``, ``b`` other than
    the least of its component; no edges, no rows."""
    with plain_plans(edges.sparkSession):
        edges = stored(edges.select("a", "b").filter("a != b").distinct())
        seen = None
        while (now := _mark(edges)) != seen:
            seen = now
            if not now[0]:
                break
            edges = _linked(_linked(edges, False), True)
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
