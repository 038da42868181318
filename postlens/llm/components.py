"""Connected components of a graph kept in a DataFrame: alternating large and small stars.

Every step is a grouped minimum (with partial sums) and a join; no neighbourhood is collected, and what a step made is
written to the shared folder before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.session import materialise


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours to the smallest node of each neighbourhood: the larger ones of all edges, or a node and its smaller ones."""
    around = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = around.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = around.join(least, "a")
    if large:
        linked = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        linked = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return linked.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b) of whole numbers; a component is its smallest node."""
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = materialise(pairs, "links")
    before = None
    state = _state(now)
    while state != before and state[0]:
        now = materialise(_star(_star(now, True), False), "stars")
        before, state = state, _state(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
