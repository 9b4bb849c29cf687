"""Connected components of a graph given as edges, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm import common


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with ``m``, the least of u and its neighbours in the table."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, ["u"]).withColumn("m", F.least("u", "m"))


def roots(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge; root is the least node of its component.

    ``edges`` has columns u and v. Alternating star steps: large stars move every
    larger neighbour to a node's least neighbour, small stars do so for the
    smaller ones. Both keep components and need logarithmically many rounds in
    practice. A hub costs rows, not a task: minima are combined before the
    shuffle and Spark splits the joins. Self loops and repeated edges are harmless.
    """
    now = common.stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = _with_least(large)
        moved = (
            small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        after = common.stored(moved, "edges")
        if after.exceptAll(now).isEmpty() and now.exceptAll(after).isEmpty():
            return after.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                after.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        now = after
