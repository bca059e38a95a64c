"""Connected components of an edge table, by alternating large-star and small-star steps.

Both steps are joins and minima over (node, node) rows; every step's edges are written to the shared folder,
so lineage stays short and a lost executor costs one step. Hubs need no care: their neighbours are minima with
map-side combine, and the join back is one that adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.session import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: neighbours move to the smallest node around their centre."""
    if large:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    joined = around.join(low, "a")
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            low.select("a", F.col("low").alias("b"))
        )
    return moved.where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge, component being its smallest node.

    ``edges`` has two long columns ``a`` and ``b``; repeated rows and loops do no harm.
    """
    edges = cut_lineage(edges.select("a", "b").where("a <> b").distinct())
    state = _state(edges)
    while True:
        edges = cut_lineage(_star(_star(edges, large=True), large=False))
        before, state = state, _state(edges)
        if state == before:
            break
    tops = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        tops.select("node", F.col("node").alias("component"))
    )
