"""Connected components of a link table, by alternating large and small stars.

Each round joins the links with the smallest neighbour of each node, so a round is two shuffles
whatever the shape of the graph, and a component of n nodes takes about log(n) rounds. The links and the
smallest neighbours of a star are written to the shared folder, which cuts the lineage and leaves the join two
plain scans: adaptive execution splits a node that a third of all links meet. Only two numbers a round, the
count and a checksum of the links, reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.plans.settle import settle


def _oriented(links: DataFrame) -> DataFrame:
    """Each link once, from its larger to its smaller end; loops and nulls go."""
    return (
        links.where("src != dst")
        .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        .distinct()
    )


def _large_star(links: DataFrame, label: str = "large") -> DataFrame:
    both = links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    lowest = settle(both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("low")), label, compact=True)
    return both.where("dst > src").join(lowest, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst")).distinct()


def _small_star(links: DataFrame, label: str = "small") -> DataFrame:
    links = settle(links, label)
    lowest = settle(links.groupBy("src").agg(F.min("dst").alias("low")), label, compact=True)
    moved = links.join(lowest, "src").where("dst != low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return moved.unionByName(lowest.select("src", F.col("low").alias("dst"))).distinct()


def _signature(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("src", "dst"))).first())


def connected_components(links: DataFrame, label: str = "components") -> DataFrame:
    """``links`` (src, dst) of any one comparable type -> (node, component): the smallest node reachable.

    Nodes without a link to another node are not listed. Links may repeat, in either direction.
    """
    current = settle(_oriented(links), label)
    before = _signature(current)
    while before[0]:
        current = settle(_small_star(_large_star(current)), label)
        after = _signature(current)
        if after == before:
            break
        before = after
    stars = current.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
