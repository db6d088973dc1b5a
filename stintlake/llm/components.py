"""Connected components of an edge table, by alternating large-star and small-star steps.

(Kiveris et al., Connected Components in MapReduce and Beyond, 2014.) All steps are grouped minima and
equi-joins; nothing is collected. Each step is stored, so plans stay short and survive lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.llm.scratch import keep


#: Rows of an edge file: a step has at most twice the edges of the one before, so its files are few.
FILE_ROWS = 500_000


def _star(edges: DataFrame, large: bool, count: int) -> DataFrame:
    """One step over `count` edges (u, v) with u > v."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    # adding 0 hides from the planner that the minima are dealt by u already: with an exchange on both
    # sides of the join, adaptive execution can split the partition of a hot node
    least = both.groupBy("u").agg(F.min("v").alias("m")).select((F.col("u") + F.lit(0)).alias("u"), F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
    return keep(out.where("u != v").distinct().coalesce(1 + 2 * count // FILE_ROWS))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link to another one; root is the component's least node."""
    a, b = links.columns[:2]
    edges = keep(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before = _state(edges)
    while before[0]:
        edges = _star(_star(edges, True, before[0]), False, before[0])
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
