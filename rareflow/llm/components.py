"""Connected components of links between rows, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareflow.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; the component is its smallest node.

    A large star hangs all larger neighbours of a node on its smallest neighbour, a small star the
    smaller ones; both keep the components and need about log squared rounds in theory, a handful in
    practice. Every step is a map-side minimum and a join that Spark can split on a hot node; no
    node's neighbours are gathered. Each round is checkpointed in the shared folder.

    Null ends and self links are dropped, repeated links count once, no links give no rows.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = cut_lineage(edges.where("a <> b").distinct())
    before = None
    while (now := _figures(edges)) != before:
        before = now
        edges = cut_lineage(_small_star(_large_star(edges)))
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.unionAll(roots)


def _figures(edges):
    folded = F.bit_xor(F.xxhash64("a", "b"))
    return tuple(edges.agg(F.count("*"), folded).first())


def _large_star(edges):
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.min("b").alias("low"))
    low = F.least("low", "a")
    return both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), low.alias("b")).where("a <> b").distinct()


def _small_star(edges):
    lowest = edges.groupBy("a").agg(F.min("b").alias("low"))
    hung = edges.join(lowest, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
    return hung.where("a <> b").distinct()
