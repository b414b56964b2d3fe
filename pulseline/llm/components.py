"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions_of, settled


def large_star(links: DataFrame, parts: int) -> DataFrame:
    """Links (u, v), u > v: every node's larger neighbours are linked to its smallest neighbour or itself."""
    both = links.union(links.select("v", "u"))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
    larger = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return larger.coalesce(parts).distinct().coalesce(parts)


def small_star(links: DataFrame, parts: int) -> DataFrame:
    """Links (u, v), u > v: every node and its smaller neighbours are linked to the smallest of these."""
    low = links.groupBy("u").agg(F.min("v").alias("low"))
    others = links.join(low, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return others.union(low.select("u", "low")).coalesce(parts).distinct().coalesce(parts)


def components(links: DataFrame) -> DataFrame:
    """(c, label) for every node of `links` (u, v): the smallest node of its component.

    Large and small stars in turn, which keep components and never make more links than there are, until every node
    is linked to its component's smallest node only. Links of a round are checkpointed; only whether there is more to do
    and how many links there are reach the driver, the latter for the number of partitions.
    """
    smaller, larger = F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")
    links = settled(links.where("u <> v").select(larger, smaller).distinct())
    parts = partitions_of(links.count())
    links = settled(small_star(links, parts))
    while True:
        # Stars it is when no node has two links and none that has a link is the end of another.
        forks = links.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
        chains = links.join(links.select(F.col("v").alias("u")), "u", "left_semi").select("u")
        if forks.union(chains).isEmpty():
            break
        links = settled(small_star(large_star(links, parts), parts))
    nodes = links.select(F.col("u").alias("c"), F.col("v").alias("label"))
    return settled(nodes.union(links.select("v", "v").distinct()))
