"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources import workdir


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to the smallest node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them. ``u`` > ``v`` on every edge."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first())


def roots(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of the component, for every node on a link ``(a, b)``.

    Each round is written to the shared folder; the number of rounds grows with
    the logarithm of the component size. Nothing but a count and a checksum of
    the edges reaches the driver. No links give an empty table.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = workdir.saved(edges, "links")
    before = _state(edges)
    while before[0]:
        edges = workdir.saved(_small_star(_large_star(edges)), "links")
        now = _state(edges)
        if now == before:
            break
        before = now
    pairs = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pairs.union(pairs.select("root", "root").distinct())
