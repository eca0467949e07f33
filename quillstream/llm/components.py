"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.llm.stage import sized, written


def _star(edges: DataFrame, small: bool, size: int) -> DataFrame:
    """One step over a written table edges(u, v). Minima are found with partial sums and written before they are joined,
    so that both sides of the join are plain shuffles and AQE can split a node with very many neighbours."""
    if small:
        rows = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        rows = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = written(sized(rows.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), size), "star-least")
    joined = sized(rows.join(least.hint("merge"), "u"), size)
    if small:
        out = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.where("u <> m").select("u", F.col("m").alias("v")))
    else:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return written(sized(out.where("u <> v").distinct(), size), "star")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges(u, v): the smallest node it is linked with, in any number of steps."""
    edges = written(edges.select("u", "v").where("u <> v").distinct(), "edges")
    size, before = 2 * edges.count(), None
    while True:
        edges = _star(_star(edges, False, size), True, size)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.expr("try_add(hash(u, v), 0L)")), F.count_distinct("v")).first()
        if now == before or not now[0]:
            break
        before = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
