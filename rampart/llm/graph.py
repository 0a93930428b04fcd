"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rampart.llm import store


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node of ``edges`` (u, v) links its neighbours (large: those above it,
    small: those below it and itself) with the smallest it knows."""
    if large:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = store.write(near.distinct(), "near")
    least = store.write(near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
    both = near.join(least, "u")
    if large:
        out = both.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = both.select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(least.select("u", F.col("m").alias("v")))
    return store.write(out.where("u <> v").distinct(), "star")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): every node of ``edges`` (u, v) but a component's smallest,
    with that smallest.  Loops and repeated edges do no harm; no edges, no rows.

    Large and small stars alternate until every edge ends in its component's
    smallest node; the number of rounds grows with the logarithm of the longest
    path.  Rows per round never exceed the edges and nodes.  A hub's edges are a
    plain join of two written tables, which Spark splits by size.
    """
    now = store.write(edges.where("u <> v").select("u", "v").distinct(), "edges")
    while True:
        now = _star(_star(now, True), False)
        # done when every node hangs on one parent only and no parent hangs itself
        roots = now.select(F.col("v").alias("u")).distinct()
        if now.join(roots, "u", "left_semi").limit(1).count() == 0 and \
                now.groupBy("u").count().where("count > 1").limit(1).count() == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("comp"))
