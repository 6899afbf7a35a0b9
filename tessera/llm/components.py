"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import discard, stage

#: A task for so many edges at least.
EDGES_EACH = 500_000


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node of `edges` (a, b).

    Each round joins an edge table with one row for each node, both written to the shared
    folder, so a node with very many edges can be split by Spark. It ends when the edges are
    stars: no node is both above and below another, and none is below two. Nothing reaches the
    driver but the number of edges, by which the tasks are counted, and whether a table is
    empty. Loops and repeats are allowed.
    """
    now = stage(edges.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "edges")
    tasks = 1 + now.count() // EDGES_EACH
    while not stars(now, tasks):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")).coalesce(tasks), "stars")
        large = both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.distinct().coalesce(tasks), "large-stars")
        discard(now, least)
        least = stage(large.groupBy("a").agg(F.min("b").alias("m")).coalesce(tasks), "stars")
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stage(small.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").unionByName(least.select("a", F.col("m").alias("b"))).distinct().coalesce(tasks), "edges")
        discard(large, least)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def stars(edges: DataFrame, tasks: int) -> bool:
    """Whether each node is either a root or has one edge, to a root."""
    roots = edges.select(F.col("b").alias("a")).distinct()
    below_two = edges.groupBy("a").count().where("count > 1").select("a")
    return below_two.unionByName(edges.select("a").join(roots, "a", "left_semi")).coalesce(tasks).isEmpty()
