"""Connected components of a graph of links, by alternating large and small stars.

Each step joins links with the smallest neighbour of their node, so no component is ever in
one task; a node with many links costs one row per link. The steps end when a round changes
nothing. Only three numbers per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeleads.llm.common import cut_lineage


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked with the node's smallest neighbour."""
    both = links.union(links.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return (
        both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    ).where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked with the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _state(links: DataFrame) -> tuple:
    row = links.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v") % 1000003), F.sum(F.hash("v", "u") % 1000003)
    ).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``(u, v)`` for every node ``u`` with a link that is not the smallest of its component:
    ``v`` is the smallest. ``links`` has two columns of numbers; their order does not matter,
    links of a node with itself are ignored."""
    a, b = links.columns
    now = cut_lineage(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "links",
    )
    state = _state(now)
    while True:
        now = cut_lineage(_small_star(_large_star(now)), "stars")
        after = _state(now)
        if after == state:
            return now
        state = after
