"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.sources.store import materialize


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _settled(links: DataFrame) -> bool:
    """Whether every node has one link, to a node that has none: then each component is a star."""
    ends = links.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("own")), F.struct(F.col("v").alias("node"), F.lit(0).alias("own")))).alias("e"))
    nodes = ends.select("e.*").groupBy("node").agg(F.sum("own").alias("links"), F.min("own").alias("least"))
    return nodes.filter((F.col("links") > 1) | ((F.col("links") == 1) & (F.col("least") == 0))).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(u, v): every node of ``links`` (u, v; any order, repeats and loops allowed) but the smallest of each component,
    with that smallest node.

    Each round ties larger neighbours to the smallest one around a node, then the rest to it, so paths shrink by half
    or more. Rounds work on the links as tables: a minimum per node, which sums up before it is dealt out, and a
    lookup of it; no node's neighbours are gathered. Each round's links are written, and rounds end with stars.
    """
    links = links.select("u", "v").filter(F.col("u") != F.col("v"))
    while True:
        around = _both_ways(links)
        least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = around.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.filter(F.col("u") != F.col("v")), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        links = materialize(small.filter(F.col("u") != F.col("v")).distinct(), "links")
        if _settled(links):
            return links
