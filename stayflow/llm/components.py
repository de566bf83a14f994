"""Connected components of a graph given as edges.

Alternates the large-star and small-star steps: every node is linked to the smallest node among its
neighbours until all edges point at the smallest node of their component.  The number of rounds
grows with the logarithm of the longest path.  Edges are written to the shared folder after each
round; only two numbers per round reach the driver, to see whether the edges have changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.sources.scratch import keep


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return moved.union(least.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mixed)).first())


def components(edges: DataFrame) -> DataFrame:
    """Rows (``node``, ``root``) for every node of edges (``u``, ``v``); root is the smallest node.

    Edges may repeat, run either way, or join a node to itself; null ends are no edges.  Nodes must
    have an order (numbers).  No edges give no rows.
    """
    now = edges.filter("u is not null and v is not null and u <> v").select("u", "v")
    now = keep(now.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(now)
    while state[0]:
        now = keep(_small_star(_large_star(now).distinct()).distinct())
        after = _state(now)
        if after == state:
            break
        state = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
