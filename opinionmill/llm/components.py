"""Connected components of a table of links, in a few rounds of grouped minima and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinionmill.session import materialized

MAX_ROUNDS = 40


def components(links: DataFrame) -> DataFrame:
    """(node, component) with the smallest node reachable, for every node of ``links`` (a, b).

    Every round hangs the larger neighbours of a node under its smallest neighbour, then does the same
    with the smaller ones; links shorten until each node hangs under the root of its component. Minima
    are taken before the shuffle, so a node with very many links costs one row per task. The rounds end
    when every child has one parent and no parent is a child; equal numbers of links would not tell, as a
    round can trade one link for another.
    """
    spark = links.sparkSession
    edges = materialized(spark, links.select(
        F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent")).where("child <> parent").distinct(),
        "links")
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("parent").alias("child"), F.col("child").alias("parent")))
        least = both.groupBy("child").agg(F.min("parent").alias("low")).select(
            F.col("child").alias("node"), F.least("child", "low").alias("low"))
        large = (
            both.where("parent > child").join(least, F.col("child") == F.col("node"))
            .select(F.col("parent").alias("child"), F.col("low").alias("parent")).distinct()
        )
        large = materialized(spark, large, "links")
        low = large.groupBy("child").agg(F.min("parent").alias("low"))
        hung = large.join(low.withColumnRenamed("child", "of"), F.col("child") == F.col("of"))
        small = (
            hung.where("parent <> low").select(F.col("parent").alias("child"), F.col("low").alias("parent"))
            .unionByName(low.select("child", F.col("low").alias("parent"))).distinct()
        )
        edges = materialized(spark, small, "links")
        if _settled(edges):
            break
    else:
        raise RuntimeError(f"links do not settle within {MAX_ROUNDS} rounds")
    return (
        edges.select(F.col("child").alias("node"), F.col("parent").alias("component"))
        .unionByName(edges.select(F.col("parent").alias("node"), F.col("parent").alias("component")).distinct())
    )


def _settled(edges: DataFrame) -> bool:
    """Every child has exactly one parent, and no parent is a child."""
    several = edges.groupBy("child").agg(F.count(F.lit(1)).alias("parents")).where("parents > 1")
    roots = edges.select(F.col("parent").alias("child")).distinct()
    return several.isEmpty() and edges.join(roots, "child", "left_semi").isEmpty()
