"""Cycle residue of a reference graph.

Peeling nodes without an incoming edge, round by round, leaves every node that lies on a cycle or is
reachable from one.  A peel takes a round for each level, so a chain of n edges would take n rounds.
Here a peel that takes away little is followed by a contraction:

- A node with a single incoming edge shares the fate of its parent.  Pointer jumping leads it, in
  O(log length) steps, to the head of its chain: the first node with no or several incoming edges.
  Pointers that never end run into a circle, so their nodes stay.
- Edges between heads are the graph that is left; a head with an edge to itself, or from a circle, stays.

When nothing can be peeled, every node has an incoming edge and stays.  The contractions are then
undone in reverse, each with one join: a node stays if its head does.  All steps are equi joins and
map-side combined aggregates on written tables; nothing is gathered, and a hub is summed before the
shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarweave.session import cut_lineage

PEEL_SHARE = 8      # a peel that takes less than this part of the edges is followed by a contraction


def chain_heads(parent: DataFrame) -> DataFrame:
    """(node, head) for ``parent`` (node, up), one row a node: where the way up ends, null if it never does.

    Pointers double each step.  The nodes of a chain have every distance up to its length, so a step
    after which no further pointer has ended leaves only ways into a circle.
    """
    before = None
    while True:
        far = parent.select(F.col("node").alias("up"), F.col("up").alias("far"))
        parent = cut_lineage(parent.select("node", "up").join(far, "up", "left").select(
            "node", F.coalesce("far", "up").alias("up"), F.col("far").isNotNull().alias("moves")), "residual-jump")
        moving = parent.where("moves").count()
        if moving in (0, before):
            return parent.select("node", F.when(~F.col("moves"), F.col("up")).alias("head"))
        before = moving


def _peel(edges: DataFrame) -> DataFrame:
    """The edges without those from a node that has no incoming edge; a null src, a circle, stays."""
    has_in = edges.select(F.col("dst").alias("src")).distinct()
    return cut_lineage(edges.where("src is not null").join(has_in, "src", "left_semi").select("src", "dst")
                       .unionByName(edges.where("src is null")), "residual-edges")


def _contract(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edges between chain heads, and (node, head) of the nodes taken out; a null head is a circle: the node stays."""
    into = cut_lineage(edges.groupBy("dst").agg(
        F.count("*").alias("n"), F.min("src").alias("up"), F.count_if(F.col("src").isNull()).alias("circles")),
        "residual-degree")
    nothing = F.lit(None).cast(edges.schema["src"].dataType)
    stay = into.where("circles > 0").select(F.col("dst").alias("node"), nothing.alias("head"))
    single = into.where("circles = 0 and n = 1").select(F.col("dst").alias("node"), "up")
    heads = chain_heads(single).unionByName(stay)               # reads of two written tables
    several = into.where("circles = 0 and n > 1").select("dst")
    moved = heads.select(F.col("node").alias("src"), "head", F.lit(True).alias("taken"))
    left = edges.join(several, "dst", "left_semi").join(moved, "src", "left").select(
        F.when(F.col("taken"), F.col("head")).otherwise(F.col("src")).alias("src"), "dst")
    circle = F.when(F.col("src") != F.col("dst"), F.col("src"))
    return cut_lineage(left.select(circle.alias("src"), "dst").distinct(), "residual-edges"), heads


def residual_nodes(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Nodes on a cycle or reachable from one (the reference's cycle check, on data).

    Edges with a null end are ignored, repeated ones count once, an edge from a node to itself is a cycle.
    """
    left = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).dropna()
    left = cut_lineage(left.select(F.when(F.col("src") != F.col("dst"), F.col("src")).alias("src"), "dst").distinct(),
                       "residual-edges")
    rounds, n = [], left.count()
    while n:
        left = _peel(left)
        n, before = left.count(), n
        if n == before:
            break
        if before - n < before / PEEL_SHARE:
            left, heads = _contract(left)
            rounds.append(heads)
            n = left.count()
    stay = left.select(F.explode(F.array("src", "dst")).alias("node")).dropna().distinct()
    for heads in reversed(rounds):
        stay = stay.unionByName(heads.where("head is null").select("node"))
        back = heads.join(stay.select(F.col("node").alias("head")), "head", "left_semi").select("node")
        stay = cut_lineage(stay.unionByName(back).distinct(), "residual-stay")
    return stay


def residual_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """The edges that the peel leaves: those from a node that stays."""
    every = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).dropna().distinct()
    return every.join(residual_nodes(edges, src, dst).select(F.col("node").alias("src")), "src", "left_semi")
