"""Connected components of a graph given as links, by alternating large-star and small-star rounds.

Every round replaces links by links to a smaller neighbour and never breaks or joins a component; it ends when the links
no longer change, after a number of rounds that grows with the logarithm of the longest chain. A node with very many
links is one key of a grouping with partial minima and of a join, so no task gathers its neighbours. Each round is
written to the shared folder, which cuts the lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binledger.session import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link to another node; root is the smallest node of its component.

    Nodes may be of any type with an order. Links with a NULL end, links of a node to itself and repeated links have
    no effect; without links the result is empty.
    """
    x, y = F.col(a), F.col(b)
    edges = links.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v"))
    edges = stage(edges.where("u is not null and v is not null and u > v").distinct(), "links")
    before = None
    while True:
        print_ = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if print_ == before or not print_[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = print_
        edges = stage(_small_star(_large_star(edges)), "links")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour (itself included)."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = both.where("v > u").join(least, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    lower = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return lower.unionByName(own).where("u > v").distinct()
