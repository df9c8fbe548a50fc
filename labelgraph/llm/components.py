"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgraph.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``; the root is the component's smallest node.

    Each step replaces links by links to the smallest neighbour, which keeps components and ends
    in stars after a logarithmic number of rounds. A node's neighbours are never gathered: their
    minimum is a partial aggregate that is joined back to the links. Null ends and loops are
    dropped, repeated links count once; no links give an empty result.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = stored(edges.filter("a is not null and b is not null and a <> b").distinct(), "links")
    before = _state(edges)
    while before[0]:
        edges = stored(_small_star(_large_star(edges)), "links")
        state = _state(edges)
        if state == before:
            break
        before = state
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    """Number and sum of hashes of the distinct links; equal before and after a step when nothing is left to do."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """At most one row for each link, so equal rows may stay for the small-star step to merge."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    out = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.filter("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    # every link runs from the larger to the smaller end; that to the smallest neighbour stays, the others' ends go to it
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()
