"""Exact sums and time arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exact_sum(c: Column | str, digits: int = 2) -> Column:
    """Sum of an amount with a fixed number of decimals, kept in a double column.

    Each value is first rounded to ``digits`` decimals. Adds whole units of the last
    decimal as 64-bit integers, so the result does not depend on the order in which
    partitions are merged.
    """
    c = F.col(c) if isinstance(c, str) else c
    unit = 10**digits
    return F.sum(F.rint(c * unit).cast("long")) / F.lit(float(unit))


def seconds_of(df: DataFrame, col: str) -> Column:
    """A whole number that grows with the column: seconds, days, or the number itself.

    Timestamps without a zone are taken apart field by field, so no daylight
    saving change of the session zone can bend the scale.
    """
    kind, c = dict(df.dtypes)[col], F.col(col)
    if kind == "timestamp_ntz":
        days = F.datediff(c, F.lit("1970-01-01").cast("date")).cast("long")
        return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    if kind == "timestamp":
        return F.unix_timestamp(c)
    if kind == "date":
        return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("long")
    return F.floor(c)


def minutes_between(df: DataFrame, earlier: str, later: str) -> Column:
    """Minutes from one timestamp column to another, whole seconds only."""
    return (seconds_of(df, later) - seconds_of(df, earlier)) / 60
