"""Connected components of a table of links, by rounds of joins on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velogrid.session import staged


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); the component is its smallest node.

    Each round links every node to the smallest node next to it, first over its larger neighbours,
    then over its smaller ones, until nothing changes (large star, small star). A node's neighbours
    are never gathered in one place: the smallest is an aggregate that combines before the shuffle.
    Nulls and links of a node to itself are left out.
    """
    spark = links.sparkSession
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = staged(spark, edges, "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = staged(spark, small.where("a <> b").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    nodes = edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(roots).distinct()
