"""Union, intersection and difference of whole rows. NULL equals NULL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """All rows of both, repeats included."""
    return a.unionByName(b)


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows found in both, once each.

    One aggregation over the tagged union: copies collapse before the shuffle,
    where a join would send every copy of a frequent row to one task.
    """
    tagged = a.withColumn("_side", F.lit(1)).unionByName(b.withColumn("_side", F.lit(2)))
    sides = tagged.groupBy(*a.columns).agg(
        F.min("_side").alias("_first"), F.max("_side").alias("_last")
    )
    return sides.where(F.col("_first") < F.col("_last")).select(*a.columns)


def subtract(a: DataFrame, b: DataFrame, dedupe: bool = False) -> DataFrame:
    """Rows of ``a`` that ``b`` does not hold, with their repeats unless ``dedupe``."""
    left = a.dropDuplicates() if dedupe else a
    right = b.select(*[F.col(c).alias(f"_b{i}") for i, c in enumerate(a.columns)]).dropDuplicates()
    same = [F.col(c).eqNullSafe(F.col(f"_b{i}")) for i, c in enumerate(a.columns)]
    return left.join(right, reduce(lambda x, y: x & y, same), "left_anti")
