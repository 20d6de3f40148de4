"""Degrees in a graph given as lines of a node followed by its neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.functions.text import has_words, tokens
from loomframe.operators.ordering import argmax, argmin_all


def degrees(lines: DataFrame, col: str = "value") -> DataFrame:
    """Number of neighbours per node, summed over all lines that start with it."""
    parts = lines.where(has_words(col)).select(tokens(col).alias("parts"))
    node, neighbours = F.col("parts")[0].alias("id"), (F.size("parts") - 1).alias("d")
    return parts.select(node, neighbours).groupBy("id").agg(F.sum("d").alias("connections"))


def most_connected(degree: DataFrame, names: DataFrame) -> DataFrame:
    """The node with most neighbours and its name; the first id as text wins a tie."""
    return argmax(degree, "connections", "id").join(_by_text(names), "id", "left")


def least_connected(degree: DataFrame, names: DataFrame) -> DataFrame:
    """All nodes with the fewest neighbours that have a name."""
    return argmin_all(degree, "connections").join(_by_text(names), "id")


def _by_text(names: DataFrame) -> DataFrame:
    """Node ids come out of the lines as text."""
    return names.select(F.col("id").cast("string").alias("id"), "name")
