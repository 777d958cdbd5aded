"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm.common import cut


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to its smallest neighbour."""
    both = _both_ways(edges)
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, move to the smallest."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(low.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (columns u, v of long); the
    component is its smallest node. Iterates until nothing changes, with the
    edges in the shared checkpoint folder; a hub's rows are combined before
    the shuffle and its join is one that AQE splits. No edges, no rows."""
    now, last = cut(edges.where("u <> v").distinct()), None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark == last or not mark[0]:
            break
        last = mark
        now = cut(_small_star(_large_star(now)).distinct())
    stars = now.select(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("component"))
    return stars.unionAll(stars.select(F.col("component").alias("node"), "component").distinct())
