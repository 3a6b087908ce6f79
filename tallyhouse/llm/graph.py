"""Connected components of an edge table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b); the component is its least node.

    Large-star and small-star steps in turn: every node points its larger neighbours, then its smaller ones, to the
    least it knows. Each step is a combined minimum and a join back, so a node with many neighbours is no group that
    meets in one task. Each round is stored, so no round is computed again.
    """
    now = _oriented(edges)
    mark = None
    while True:
        now = stored(_small_star(_large_star(now)), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _oriented(edges: DataFrame) -> DataFrame:
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    # The larger of an edge's ends goes to the least neighbour of the smaller one.
    return edges.join(least.withColumnRenamed("a", "b"), "b").select("a", F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    edges = _oriented(edges)
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    to_least = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return to_least.filter("a <> b").distinct()
