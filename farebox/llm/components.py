"""Connected components of a link table by alternating star contraction (large star, small star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.tasks import stored


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "to")), F.sum(F.xxhash64("node", "to").cast("decimal(38,0)"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = links.union(links.select(F.col("to").alias("node"), F.col("node").alias("to")))
    least = both.groupBy("node").agg(F.least(F.min("to"), F.col("node")).alias("least"))
    return both.where("to > node").join(least, "node").select(F.col("to").alias("node"), F.col("least").alias("to")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of those neighbours."""
    least = links.groupBy("node").agg(F.min("to").alias("least"))
    others = links.join(least, "node").where("to <> least").select(F.col("to").alias("node"), F.col("least").alias("to"))
    return others.union(least.select("node", F.col("least").alias("to"))).distinct()


def connected_components(links: DataFrame, node: str, to: str) -> DataFrame:
    """``node``, ``root``: the smallest node reachable, for every node of the links that isn't itself a root.

    Links may point either way and repeat; links of a node to itself and links with NULL are ignored; without links
    the result is empty. Each round is written to the shared folder; the rounds needed grow with the logarithm of the
    longest chain.
    """
    pairs = links.select(F.greatest(node, to).alias("node"), F.least(node, to).alias("to"), F.col(node).alias("a"), F.col(to).alias("b"))
    now = stored(pairs.where("node > to and a is not null and b is not null").select("node", "to").distinct(), "links")
    state = _state(now)
    while state[0]:
        now = stored(_small_star(_large_star(now)), "links")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select("node", F.col("to").alias("root"))
