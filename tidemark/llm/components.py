"""Connected components of a graph too large for one machine: alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch


def _to_minimum(pairs: DataFrame, node: str, other: str) -> DataFrame:
    """Each pair with the smallest ``other`` of its ``node`` as ``least``.

    The minimum is an aggregate with partial sums and comes back by an equi-join, which adaptive
    execution splits, so a node with very many neighbours loads no single task.
    """
    return pairs.join(pairs.groupBy(node).agg(F.min(other).alias("least")), node)


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to the least of node and neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = _to_minimum(both, "a", "b").where("b > a")
    return linked.select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the least of these. Edges have a > b."""
    linked = _to_minimum(edges, "a", "b")
    others = linked.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return others.unionByName(linked.select("a", F.col("least").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of an edge but the smallest of each component.

    ``edges`` has two long columns ``a, b``; loops and nulls are ignored, order and repeats do not
    matter.  ``component`` is the smallest node.  The rounds (logarithmic in the nodes) are staged
    in the shared folder, and each replaces the last.
    """
    scratch = Scratch(edges.sparkSession, "components")
    now = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    now, seen = scratch.stage(now.distinct(), "edges"), None
    while True:
        mark = now.agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")
        ).first()
        if mark == seen or mark.n == 0:
            break
        seen = mark
        after = scratch.stage(_small_star(_large_star(now)), "edges")
        scratch.drop(now)
        now = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
