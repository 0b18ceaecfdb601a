"""Connected components of a link table by rounds of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import storage


def _stars(links: DataFrame, larger: bool) -> DataFrame:
    """Link neighbours of each node to its smallest one: the larger neighbours, or the smaller ones and the node.

    The smallest neighbour is a sum over partial minima and a join, so no node's neighbours are held together.
    """
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else links
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(low, "a")
    if larger:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b"))).where("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link, root being the smallest node of its component.

    ``links`` has two long columns, a and b; loops and repeats are allowed. Large stars and small stars alternate
    until nothing changes, which takes about the logarithm of the longest path. Each round is a written table, and
    the one before it is removed.
    """
    spark = links.sparkSession
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    before, path = None, None
    while True:
        following = storage.scratch_path(spark, "links")
        now = storage.materialize(_stars(_stars(links, True), False) if path else links, following)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if path:
            storage.delete(spark, path, recursive=True)
        links, path = now, following
        if state == before or state[0] == 0:
            break
        before = state
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
