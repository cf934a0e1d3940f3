"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyground.llm.common import staged


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = staged(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")
    larger = both.filter("v > u").join(least.hint("merge"), "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    least = staged(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    tied = down.join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (``u, v``); the label is the component's smallest node.

    The steps keep the number of edges and end in stars after about log(n) rounds. Each
    round is written to the shared folder, so lineage does not grow and a lost executor
    costs one step. Nothing but a sum and a count per round reaches the driver.
    """
    edges = staged(edges.filter("u <> v").distinct(), "edges")
    before = None
    while True:
        edges = staged(_small(staged(_large(edges), "large")), "small")
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    labels = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labels.union(labels.select(F.col("label").alias("node"), "label").distinct())
