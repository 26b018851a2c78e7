"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tribuna.llm.common import one_row
from tribuna.session import cut_lineage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root``: the smallest node reachable, for every node that has an edge to another.

    Each round hangs every neighbour of a node below the smallest node around;
    aggregates and joins only, so a node with any number of edges is no group of
    rows in one task.  The rounds grow with the logarithm of the longest path.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    e, before = cut_lineage(e), None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("s"))
        e = cut_lineage(small.select("s.u", "s.v").where("u > v").distinct())
        now = tuple(one_row(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))))
        if now == before:
            break
        before = now
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select("root", "root").distinct())
