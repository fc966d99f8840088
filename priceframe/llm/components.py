"""Connected components by alternating large-star and small-star rounds over an edge table.

Each round takes every vertex's smallest neighbour as a partial minimum and joins it back to the edges, so no task ever holds
the neighbours of a vertex together; rounds end when the edges no longer change. Lineage is cut by checkpoint() each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk


def components(edges: DataFrame, left: str, right: str, loops: bool = False) -> DataFrame:
    """edges (left, right: long) -> (node, root): every vertex of an edge with the smallest vertex it is connected to.

    Repeated edges and either order are accepted; edges with a null end are ignored; no edges give no rows. Edges from a
    vertex to itself are ignored too, but with loops a vertex that has no other edge is its own root.
    """
    tk.ensure_checkpoint_dir(edges.sparkSession)
    pairs = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).where(F.col(left).isNotNull() & F.col(right).isNotNull())
    state = pairs.where("u != v").distinct().checkpoint()
    seen = None
    while True:
        mark = state.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == seen or not mark["n"]:
            break
        seen = mark
        both = state.union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")).select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
        state = small.where("u != v").distinct().checkpoint()
    roots = state.select(F.col("u").alias("node"), F.col("v").alias("root"))
    out = roots.union(roots.select("root").distinct().select(F.col("root").alias("node"), "root"))
    if not loops:
        return out
    own = pairs.where("u = v").select(F.col("u").alias("node")).distinct().join(out, "node", "left_anti")
    return out.union(own.select("node", F.col("node").alias("root")))
