"""Connected components of links between numbered things, by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from starloom.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    return both.join(least, F.col("u") == F.col("c")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m")
    moved = down.join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select(F.col("c").alias("u"), F.col("m").alias("v"))).where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """id, root for every node of `edges` (u, v; long): root is the smallest node of its component.

    Links of a node with itself and links with null are ignored; without links there are no rows. Each round is written
    to the shared folder; rounds end when a round changes no link.
    """
    edges = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    before = None
    while True:
        seen = Observation()
        edges = materialize(edges.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")))
        state = (seen.get["n"], seen.get["s"])
        if state == before or not state[0]:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
        before = state
        edges = _small_star(_large_star(edges))
