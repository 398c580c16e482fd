"""Connected components of a graph of links, by star operations on the table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.sources.staging import staged


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").distinct()


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """node, root: every node that has a link, with the least node it can reach.

    Each round hangs the larger neighbours of a node on its least neighbour, then the node and its smaller neighbours
    on the least of these, until nothing changes; rounds grow with the logarithm of the longest path. A node's
    neighbours are never gathered: minima are partial aggregates, joined back. Every round's links are written.
    """
    edges = staged(_distinct(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))), "links")
    mark = _mark(edges)
    while mark[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        hung = _distinct(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        lower = hung.groupBy("u").agg(F.min("v").alias("m"))
        moved = hung.join(lower, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = staged(_distinct(moved.union(lower.select("u", F.col("m").alias("v")))), "links")
        before, mark, edges = mark, _mark(new), new
        if mark == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal sets of links: their number and a sum of hashes."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
