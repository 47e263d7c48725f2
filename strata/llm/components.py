"""Connected components of a graph that is given as edge rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import cut_lineage


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) edges -> (node, component): the smallest node of each component.

    Alternating large-star and small-star rounds: every node links its larger
    neighbours, then its smaller ones, to the smallest node it sees, until
    nothing changes.  Each round writes its edges to the shared checkpoint
    folder; only counts reach the driver.  Loops and repeated edges don't
    matter, nulls are left out; an empty table gives no rows.
    """
    edges = edges.select("a", "b").where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = cut_lineage(edges, "cc")
    nodes = cut_lineage(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "cc-nodes")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("_m"))
        least = least.select(F.col("a").alias("_a"), F.least("_m", "a").alias("_m"))
        # Large star: every larger neighbour goes to the smallest.
        large = both.where(F.col("b") > F.col("a")).join(least, F.col("a") == F.col("_a")).select(F.col("b").alias("a"), F.col("_m").alias("b")).distinct()
        large = cut_lineage(large, "cc")
        # Small star: the smaller neighbours and the node itself go to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("_m")).withColumnRenamed("a", "_a")
        joined = large.join(least, F.col("a") == F.col("_a"))
        small = joined.where(F.col("b") != F.col("_m")).select(F.col("b").alias("a"), F.col("_m").alias("b"))
        small = small.unionByName(least.select(F.col("_a").alias("a"), F.col("_m").alias("b"))).distinct()
        small = cut_lineage(small, "cc")
        same = small.select(F.xxhash64("a", "b").alias("h")).agg(F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s")).first()
        was = edges.select(F.xxhash64("a", "b").alias("h")).agg(F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s")).first()
        edges = small
        if same == was:
            break
    found = edges.groupBy("a").agg(F.min("b").alias("_m"))
    return nodes.join(found, nodes["node"] == found["a"], "left").select("node", F.coalesce("_m", "node").alias("component"))
