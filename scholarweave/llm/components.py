"""Connected components of an edge table by alternating large-star and small-star rounds.

Each round is two min-aggregates (combined map-side, so a hub is summed before the shuffle) and two
equi joins; its edges are written to the shared checkpoint folder.  No group of edges is gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarweave.session import cut_lineage


def _to_minimum(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with the smallest b of each a, not below a itself."""
    return edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return (both.join(_to_minimum(both), "a").where("b > a and b != m")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = _to_minimum(down)
    moved = down.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Every edge joins a leaf to its only, smallest root."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("leaf")).unionByName(
        edges.select(F.col("b").alias("n"), F.lit(0).alias("leaf")))
    odd = ends.groupBy("n").agg(F.sum("leaf").alias("up"), F.count("*").alias("all"))
    return odd.where("up > 1 or (up = 1 and all > 1)").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): label is the smallest node reachable.

    Loops and repeated edges are ignored, and so are edges with a null end; no edges give no rows.
    """
    edges = cut_lineage(edges.select("a", "b").where("a != b").distinct(), "cc")
    while not _settled(edges):
        edges = cut_lineage(_small_star(_large_star(edges)), "cc")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)
