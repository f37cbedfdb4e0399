"""Connected components of links, as joins and group-bys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktake.session import stage


def _hang(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are hung on its smallest neighbour (or itself)."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    return (
        both.where("v > u").join(least, "u").select(F.col("least").alias("u"), "v").where("u <> v").distinct()
    )


def _gather(edges: DataFrame) -> DataFrame:
    """Every node's smaller neighbours, and the node, are hung on the smallest of them.
    ``edges`` point from smaller ``u`` to larger ``v``."""
    least = edges.groupBy("v").agg(F.min("u").alias("least"))
    moved = edges.join(least, "v")
    own = least.select(F.col("least").alias("u"), "v")
    hung = moved.select(F.col("least").alias("u"), F.col("u").alias("v"))
    return own.union(hung).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node of ``links``
    (columns u, v) but the roots themselves.

    The two steps alternate until every component is a star around its smallest node, which
    takes about as many rounds as the logarithm of the longest path. Each round is staged. No
    node's neighbours are ever gathered in one place: minima are taken before the shuffle,
    and the joins can be split.
    """
    low, high = F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")
    edges = stage(links.select(low, high).where("u <> v").distinct(), "links")
    while True:
        after = stage(_gather(_hang(edges)), "links")
        # A star forest hangs every node once, and no root is hung itself.
        nodes = after.agg(F.count("*").alias("edges"), F.count_distinct("v").alias("members")).first()
        roots = after.select(F.col("u").alias("v")).distinct().join(after.select("v"), "v", "left_semi")
        if nodes.edges == nodes.members and roots.isEmpty():
            return after.select(F.col("v").alias("node"), F.col("u").alias("root"))
        edges = after
