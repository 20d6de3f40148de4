"""Top rows and rows at an extreme.

Every ordering that cuts off takes a unique last column, so that ties always
fall the same way. Each is planned as a partial top-k per task, never a full sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: list[Column | str], k: int) -> DataFrame:
    """The first ``k`` rows in this order."""
    return df.orderBy(*order).limit(k)


def largest(df: DataFrame, col: str, n: int) -> DataFrame:
    """The ``n`` largest values, repeats included, as a one-column frame."""
    return df.select(col).where(F.col(col).isNotNull()).orderBy(F.desc(col)).limit(n)


def smallest(df: DataFrame, col: str, n: int) -> DataFrame:
    """The ``n`` smallest values, repeats included, as a one-column frame."""
    return df.select(col).where(F.col(col).isNotNull()).orderBy(F.asc(col)).limit(n)


def argmax(df: DataFrame, by: str, tiebreak: str) -> DataFrame:
    """The one row with the largest value; the smallest tie-break wins."""
    return df.orderBy(F.desc_nulls_last(by), F.asc(tiebreak)).limit(1)


def argmin_all(df: DataFrame, by: str) -> DataFrame:
    """All rows at the smallest value."""
    return df.where(F.col(by) == df.agg(F.min(by)).scalar())
