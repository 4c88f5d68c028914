"""Connected components of a graph of links, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _state(edges: DataFrame):
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``links`` (u, v: comparable ids) to one row ``(node, root)`` for each
    node with a link to another: root is the smallest node reachable.

    Alternates large-star and small-star steps (each joins every node's
    links with the smallest neighbour, a map-side ``min``) until nothing
    changes; each round is written to the shared folder.  The joins are
    plain, so adaptive execution splits a node with many links."""
    edges = staged(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = staged(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        edges = staged(small, "small-star")
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
