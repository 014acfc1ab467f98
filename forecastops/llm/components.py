"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecastops.session import cut


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its smallest node.

    Every step replaces links by links to smaller nodes and is written to the shared folder; the number of steps grows with
    the logarithm of the longest path. A node with very many links is an aggregate and one side of a join that adaptive
    execution may split, never a group in one task. Null ends and loops are left out.
    """
    links = cut(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        # large star: neighbours that are larger than a node go to its smallest neighbour
        around = _both_ways(links)
        least = around.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        large = around.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        # small star: a node and its smaller neighbours go to the smallest of them
        large = large.filter("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(low, "a").filter("b != least").select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(low.select("a", F.col("least").alias("b")))
        links = cut(small.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        state = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if before == state:
            break
        before = state
    roots = links.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
