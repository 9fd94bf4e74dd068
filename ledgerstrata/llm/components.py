"""Connected components by alternating large and small stars.

Each half round is one aggregation and one join. A node with very many
neighbours is met by partial minima in the aggregation and by adaptive skew
handling in the join, whose sides are stored tables; no neighbour list is ever
gathered. Nothing but two numbers per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstrata.llm.common import stored


def _mark(edges: DataFrame) -> tuple:
    """A fingerprint of the edge set that does not depend on row order."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Connect the larger (or smaller) neighbours of every node to its least neighbour."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    sides = both if large else both.where("v < u")
    least = sides.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    least = stored(least, "stars")
    linked = sides.where("v > u") if large else sides
    moved = linked.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(u, v)`` edges between different longs to ``(node, root)``, root the least node.

    Root nodes themselves have no row; an empty edge set gives no rows.
    """
    edges = stored(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where("u <> v")
        .distinct(),
        "edges",
    )
    mark = _mark(edges)
    while mark[0]:
        edges = stored(_star(stored(_star(edges, True), "large-star"), False), "small-star")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
