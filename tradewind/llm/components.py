"""Connected components of links by alternating large and small stars.

Every round rewires links towards the smallest neighbour; the number of rounds grows with
the logarithm of a component's size. Links are staged after every round, so the lineage is
short; only the answer whether all are stars by now comes to the driver. Hubs are the hot keys: their
minimum is combined before the shuffle, and the join back can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """(id, component) of all ends of `links` (a, b); the component is its smallest id. Lone ids are not returned."""
    links = stage(
        links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _is_star(links):
        links = stage(_small_star(_large_star(links)), "links")
    ends = links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return ends.unionByName(ends.select(F.col("component").alias("id"), "component").distinct())


def _is_star(links: DataFrame) -> bool:
    """Whether every node has one link, to a smaller one, or is what others link to, but not both."""
    ends = links.select(F.col("a").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("to")).unionByName(
        links.select(F.col("b").alias("id"), F.lit(0).alias("out"), F.lit(1).alias("to")))
    nodes = ends.groupBy("id").agg(F.sum("out").alias("out"), F.max("to").alias("to"))
    return nodes.where((F.col("out") + F.col("to")) > 1).isEmpty()


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them; links point from larger to smaller."""
    links = links.where("a <> b").distinct()
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
