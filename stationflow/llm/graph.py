"""Connected components of links by alternating large and small stars, as DataFrame steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import written

MAX_ROUNDS = 60


def _checked(links: DataFrame) -> tuple[DataFrame, tuple]:
    links = written(links, "links")
    print_of = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return links, tuple(links.agg(F.count("*"), print_of).first())


def _smallest(links: DataFrame) -> DataFrame:
    """The smallest neighbour of each node; summed before the shuffle and written, so a hub can be split in the join."""
    return written(links.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")), "smallest")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (u, v), component being the smallest node reachable.

    Nodes are integers; a null end, a loop or a repeated link changes nothing. Each round is two
    aggregations and two joins over at most as many rows as there are links; the number of
    rounds grows with the logarithm of the longest path. Nothing of the graph comes to the driver but
    a count and a checksum per round.
    """
    both = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    state, mark = _checked(both.where("u <> v").distinct())
    for _ in range(MAX_ROUNDS):
        # Large star: every larger neighbour of a node moves to the node's smallest neighbour, itself included.
        arrows = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _smallest(arrows).select("w", F.least("w", "m").alias("m"))
        large = arrows.where("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v").distinct(), "large")
        # Small star: the smaller neighbours of a node, and the node, move to the smallest of them.
        least = _smallest(large)
        small = large.join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.where("u <> v").unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v")))
        state, now = _checked(small.distinct())
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("the stars did not settle")
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
