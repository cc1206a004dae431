"""Connected components of a distributed edge list, by alternating star operations.

Edges (u, v) with u > v over long node ids. Each round joins the edges with the
least neighbour of a node, found by partial aggregation; a node with very many
edges is a skewed key of that join, which adaptive execution splits. Every
round's edges are written to the shared folder, and the round before's deleted. Nothing is brought to the driver but counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import materialize, release


def _down(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger to the smaller end."""
    return edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _down(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _down(moved.unionByName(least.select("u", F.col("m").alias("v"))))


def components(edges: DataFrame, tag: str = "components") -> DataFrame:
    """node, root for every node that has an edge; the root is the least node of its component.

    The table is written to the shared folder; release() may delete it.
    """
    now = materialize(_down(edges), tag)
    seen = None
    while True:
        after = materialize(_small_star(_large_star(now)), tag)
        release(now)
        now = after
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    out = materialize(stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()), tag)
    release(now)
    return out
