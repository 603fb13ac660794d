"""Connected components of a graph too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabready.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the edges ``a, b``; a component is
    named by its smallest node.

    Alternating stars: in each round every node first links its larger
    neighbours, then its smaller ones, to the smallest node it knows, until all
    edges point at their component's name.  Smallest neighbours come from a
    partial aggregate and go back by an equi-join that adaptive execution can
    split, so a hub does not meet in one task.  Rounds go on until nothing
    changes; their number grows with the logarithm of a component's size.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        edges = written(small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                        .unionByName(small.select("a", F.col("m").alias("b"))).distinct(), "edges", edges)
        after = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).first()
        if after == before:
            break
        before = after
    names = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return names.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
