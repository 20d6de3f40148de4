"""Counts of access-log lines over a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.plans.logs import access_log


def access_events(lines: DataFrame, ts: str = "ts", col: str = "value") -> DataFrame:
    """The time of each line with its ten fields; a stream stays a stream."""
    return access_log(lines, col, keep=(ts,))


def windowed_counts(events: DataFrame, by: str, ts: str = "ts", window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Rows per window of time and value of ``by``: ``window_start``, ``by``, ``n``.

    A window comes out once, when the newest time seen is ``delay`` past its end. Rows that
    come later than that are dropped and counted by Spark as late. A row with a time but
    NULL in ``by`` counts like any other value; it also moves time on, so one such row
    far ahead closes all windows before it.

    Counts are added up in each task before the shuffle, and the state holds one number
    for each open window and value.
    """
    counted = events.withWatermark(ts, delay).groupBy(F.window(ts, window).alias("_window"), by).agg(F.count("*").alias("n"))
    return counted.select(F.col("_window.start").alias("window_start"), by, "n")


def counts_so_far(windows: DataFrame, by: str, name: str = "n") -> DataFrame:
    """Totals per value over all windows that came out, from what ``windowed_counts`` wrote."""
    return windows.groupBy(by).agg(F.sum("n").alias(name))
