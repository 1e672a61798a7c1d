"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlens.operators.scale import cut_lineage


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Neighbours of each node u hang on the least node m of u and its neighbours: the larger
    ones (large star), or the smaller ones and u itself (small star). The least neighbour is an
    aggregate, so a node with very many neighbours is reduced inside each task first."""
    if larger:
        pairs = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    else:
        pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = pairs.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("m"))
    hung = pairs.join(least, "a")
    if larger:
        out = hung.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b")))
    return out.where("a != b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")),
                           F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node of its component) for every node with an edge.

    `edges`: a, b of any ordered type. Each round is written to the shared folder; the rounds
    needed grow with the logarithm of the number of nodes."""
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = cut_lineage(edges.where("a != b").distinct())
    last = _state(edges)
    while True:
        edges = cut_lineage(_stars(_stars(edges, True), False))
        now = _state(edges)
        if now == last:
            break
        last = now
    tree = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return tree.union(tree.select(F.col("root").alias("node"), "root").distinct())
