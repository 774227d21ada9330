"""Connected components of links between longs, by alternating large and small stars.

Every step is a grouped minimum (partial sums before the shuffle) and an equi-join, so no
node's neighbours are ever gathered in one task; a hub's rows may be split by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint


def connected(links: DataFrame) -> DataFrame:
    """(node, component) for each node of `links(src, dst)`; component is the smallest node reachable.

    Null ends, loops and repeated links are ignored; without links the result is empty.
    """
    edges = checkpoint(links.where("src != dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct())
    seen = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("src", "dst").cast("decimal(20,0)")).alias("h")).first()
        if not state["n"] or state == seen:
            break
        seen = state
        edges = checkpoint(_small_star(_large_star(edges)))
    nodes = edges.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    return nodes.unionByName(edges.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Join each node's larger neighbours to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("low"))
    return both.where("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst")).where("src != dst").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Join each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("src").agg(F.min("dst").alias("low"))
    down = edges.join(least, "src").where("dst != low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return down.unionByName(least.select("src", F.col("low").alias("dst"))).distinct()
