"""Connected components of an edge table by alternating stars.

Each round hangs the neighbours of every node on the smallest node among them,
first the larger neighbours, then the smaller ones; a graph of n nodes needs
about log(n) rounds. Every round is written to the shared folder, only a count
and a checksum come to the driver, and a hub's neighbours meet it by a join,
which Spark splits where it is skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from torque.llm.columns import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b); root is the smallest node."""
    edges = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .filter("u <> v").distinct())
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(
            F.xxhash64("u", "v").cast("decimal(38, 0)")).alias("sum")).first()
        if state == seen or state["n"] == 0:
            break
        seen = state
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = stored(both.filter("v > u").join(least, "u")
                       .select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .filter("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = stored(large.join(least, "u").filter("v <> m")
                       .select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .union(least).distinct())
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
