"""Connected components of an edge table, by alternating large and small
stars.  Nodes are any orderable values; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanloom.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the least
    node of its component.  Ends when an iteration changes no edge."""
    state = materialize(edges.select("a", "b").where("a != b").distinct(), "edges")
    seen = None
    while True:
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if not now[0] or tuple(now) == seen:
            break
        seen = tuple(now)
        state = materialize(_small_star(_large_star(state).distinct()), "edges")
    nodes = state.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(state.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
