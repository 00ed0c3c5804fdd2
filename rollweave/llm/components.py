"""Connected components of a link table, by repeated hooking to the least neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollweave.session import materialise_stage


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a long, b long): the least node that links reach.

    Large-star and small-star rounds: each round joins every node to the least node near it, which
    halves paths. Every step groups by minimum (combined before the shuffle) and joins; a hub with very
    many links only meets its links as join rows. A round's table goes to the shared folder, so lost
    executors cost no more than that round.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = materialise_stage(edges, "links")
    before = None
    while True:
        # Large star: neighbours above a node go to the least of its neighbourhood.
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        # Small star: neighbours not above a node, and the node, go to the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
        edges = materialise_stage(small.unionAll(low.select("a", F.col("low").alias("b"))).distinct(), "links")
        # Stars have one edge for each node and their sums do not change any more.
        now = edges.agg(F.count("*"), F.countDistinct("a"), F.sum(F.col("b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node").unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
