"""Connected components of a distributed graph by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.llm.text import stored


def _step(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: larger neighbours of a node point to its smallest one. Small star: smaller ones and the node do."""
    if large:
        sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    else:
        sides = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = sides.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    moved = sides.join(low, "u")
    if large:
        out = moved.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select("u", "m").toDF("a", "b"))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every node of an edge and the smallest node it is linked to, itself included.

    Each round is two joins on the edges that are left and is written to the shared
    folder, so a lost executor costs one round at most; the number of rounds grows with
    the logarithm of the longest path. No node's neighbours are ever gathered. Null ends
    and loops are no edges; an empty table gives an empty one.
    """
    edges = stored(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct())
    before = None
    while True:
        facts = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        if facts["n"] == 0 or (facts["n"], facts["h"]) == before:
            break
        before = (facts["n"], facts["h"])
        edges = stored(_step(_step(edges, True), False))
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(stars.select("root", "root").distinct())
