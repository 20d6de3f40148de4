"""Connected components of a graph given as links, by contraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.llm.common import kept


def _ranked(node: Column) -> Column:
    """Nodes in an order that has nothing to do with their ids, so that no chain of ids takes many rounds."""
    return F.struct(F.xxhash64(node).alias("rank"), node.alias("node"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``: the smallest node that can be reached, for every node that has a link.

    Each round every node points to the first of its neighbours and itself in a
    random order, pointers are followed once more, and links between different
    targets go on to the next round; the number of nodes falls by a constant
    factor. A node with very many links is one row per task in the aggregate,
    and its links are spread by the skew handling of joins. Rounds are kept in
    the shared folder. Links of a node to itself and repeated or null links count for nothing.
    """
    edges = kept(
        links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        .where("a is not null and b is not null and a <> b")
        .distinct(),
        "links",
    )
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
        first = both.groupBy("node").agg(F.min(_ranked(F.col("other"))).alias("best"))
        first = first.select("node", F.least("best", _ranked(F.col("node")))["node"].alias("to"))
        first = kept(first, "pointers")
        onward = first.select(F.col("node").alias("to"), F.col("to").alias("further"))
        step = kept(
            first.join(onward, "to", "left").select("node", F.coalesce("further", "to").alias("to")), "step"
        )
        steps.append(step)
        moved = edges
        for side in ("a", "b"):
            target = step.select(F.col("node").alias(side), F.col("to").alias(f"to_{side}"))
            moved = moved.join(target, side)
        edges = kept(
            moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
            .where("a <> b")
            .distinct(),
            "links",
        )
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))

    def follow(labels: DataFrame, step: DataFrame) -> DataFrame:
        onward = step.select(F.col("node").alias("to"), F.col("to").alias("further"))
        return labels.join(onward, "to", "left").select("node", F.coalesce("further", "to").alias("to"))

    roots = reduce(follow, steps[1:], steps[0])
    smallest = roots.groupBy("to").agg(F.min("node").alias("component"))
    return kept(roots.join(smallest, "to").select("node", "component"), "components")
