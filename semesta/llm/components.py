"""Connected components of an edge table, by large-star and small-star steps on DataFrames.

Every node ends with the smallest node it can reach. Each round keeps the edge count within that of the
input; both steps shuffle by node, and a hub's edges are reduced before they meet (a minimum combines).
Rounds are written to the shared folder, so a lost executor costs one step, not the whole chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semesta.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Join each node's neighbours to the least of them and itself: the larger ones, or the smaller ones."""
    if large:
        around = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = around.join(least, "u")
    if large:
        out = moved.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v) that isn't its own root."""
    edges = stored(edges.filter(F.col("u") != F.col("v")).distinct(), "edges")
    before = None
    while True:
        edges = stored(_star(_star(edges, True), False), "edges")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
