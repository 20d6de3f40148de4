"""Grouped and global aggregates.

All are built from functions with partial aggregation: each task sends one row
per key it met, so a key that holds a third of the data costs one row per task.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.functions.numeric import exact_sum

Keys = str | list[str]


def _list(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def total_by(
    df: DataFrame, keys: Keys, col: Column | str, name: str = "total", digits: int | None = None
) -> DataFrame:
    """Sum per key. ``digits`` sums amounts with that many decimals exactly."""
    total = F.sum(col) if digits is None else exact_sum(col, digits)
    return df.groupBy(*_list(keys)).agg(total.alias(name))


def mean_by(
    df: DataFrame, keys: Keys, col: Column | str, name: str = "mean", digits: int | None = None
) -> DataFrame:
    """Average per key, over an exact sum if ``digits`` is given."""
    mean = F.avg(col) if digits is None else exact_sum(col, digits) / F.count(col)
    return df.groupBy(*_list(keys)).agg(mean.alias(name))


def count_by(df: DataFrame, keys: Keys, col: str = "*", name: str = "n") -> DataFrame:
    """Rows per key, or values of ``col`` that are not NULL."""
    return df.groupBy(*_list(keys)).agg(F.count(col).alias(name))


def summarize(df: DataFrame, col: str) -> DataFrame:
    """One row with the sum, largest and smallest value."""
    return df.agg(
        F.sum(col).alias("total"), F.max(col).alias("largest"), F.min(col).alias("smallest")
    )


def fold_sum(df: DataFrame, col: str, zero: Any = 0, name: str = "total") -> DataFrame:
    """Sum starting from ``zero``, which is also the result for no rows."""
    return df.agg((F.coalesce(F.sum(col), F.lit(0)) + F.lit(zero)).alias(name))


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """How often each value occurs."""
    return count_by(df, col, name=name)


def find_duplicates(df: DataFrame, keys: Keys, name: str = "n") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return count_by(df, keys, name=name).where(F.col(name) > 1)


def pivot_sum(
    df: DataFrame, row: Keys, col: str, value: Column | str, values: list[Any] | None = None
) -> DataFrame:
    """Sums as a table of ``row`` by the values of ``col``.

    Name the values where they are known: otherwise Spark first runs a query to
    find them.
    """
    return df.groupBy(*_list(row)).pivot(col, values).agg(F.sum(value))


def pivot_or_map(
    df: DataFrame, row: Keys, col: str, value: Column | str, limit: int = 1000, name: str = "by_value"
) -> DataFrame:
    """``pivot_sum`` without given values: a column for each value of ``col``, or one map where there are more than ``limit``.

    A first query looks for at most ``limit + 1`` values. Beyond the limit a plan with a
    column for each would not do, so ``name`` then maps the values that a row has, as text,
    to its sums; it holds no entry for the others. NULL is the text ``null`` in both forms.
    """
    text = F.coalesce(F.col(col).cast("string"), F.lit("null"))
    sums = df.groupBy(*_list(row), text.alias("_value")).agg(F.sum(value).alias("_sum"))
    found = df.select(text.alias("_value")).distinct().limit(limit + 1).collect()
    if len(found) <= limit:
        return sums.groupBy(*_list(row)).pivot("_value", sorted(r[0] for r in found)).agg(F.sum("_sum"))
    # One entry for each value of a row, after the sums: what a map holds is as long as a row of the table would be.
    entries = F.array_sort(F.collect_list(F.struct(F.col("_value"), F.col("_sum"))))
    return sums.groupBy(*_list(row)).agg(F.map_from_entries(entries).alias(name))


def salt(df: DataFrame, salts: int) -> Column:
    """A bucket from 0 to ``salts - 1`` that spreads rows of any one key.

    It depends on the row's content and on the partition it is in, so a repeated
    task gives every row the same bucket, and copies of one row spread as well.
    """
    spread = F.xxhash64(*df.columns, F.spark_partition_id())
    return F.pmod(spread, F.lit(salts)).cast("int")


def salted_agg(df: DataFrame, keys: Keys, col: str, salts: int = 16) -> DataFrame:
    """Sum and count per key in two stages, first per (key, salt).

    For a key so hot that even one row per task is too much for one reducer. The salt
    is the task's, so a task sends one row per key into the first stage.
    """
    keys = _list(keys)
    narrow = df.select(*keys, col)
    task = F.pmod(F.spark_partition_id(), F.lit(salts))
    part = narrow.withColumn("_salt", task).groupBy(*keys, "_salt")
    return (
        part.agg(F.sum(col).alias("_sum"), F.count(col).alias("_count"))
        .groupBy(*keys)
        .agg(F.sum("_sum").alias("total"), F.sum("_count").alias("n"))
    )
