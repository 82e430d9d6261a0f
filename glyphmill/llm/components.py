"""Connected components of a graph given by its edges, by alternating large-star and small-star steps.

A node of very many edges is no hot key: nodes with more than a thousandth of all edges are fewer than two thousand, so
what is known of them is broadcast; all others meet their edges by a shuffle.

Defined cases: loops and repeated edges are ignored, rows with a null end too; ties don't exist (nodes differ); an empty
table of edges gives an empty result. Tables of earlier rounds are removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, hot_join, materialise


def _star(edges: DataFrame, large: bool, made: list[str]) -> DataFrame:
    """edges (u, v), u > v. Large: each node's larger neighbours are tied to the smallest node around it; small: each
    node and its smaller neighbours are."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("least"), F.count("*").alias("n_left")).withColumn("least", F.least("u", "least"))
    least = materialise(least, made)
    tied = hot_join(both, least, "u")
    if large:
        out = tied.filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    else:
        out = tied.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(least.select("u", F.col("least").alias("v")))
    return out.filter("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of an edge (u, v: bigint); root is the smallest node reachable."""
    spark, old = edges.sparkSession, []
    current = materialise(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct(), old)
    mark = None
    while True:
        seen = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark or not seen[0]:
            break
        mark, new, steps = seen, [], []
        large = materialise(_star(current, True, steps), steps)
        current = materialise(_star(large, False, steps), new)
        discard(spark, old + steps)
        old = new
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
