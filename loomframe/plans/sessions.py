"""Sessions in a stream of timestamped rows per user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomframe.functions.numeric import seconds_of
from loomframe.operators.joins import attach
from loomframe.operators.windows import slice_hot


def sessionize(
    df: DataFrame,
    user: str,
    ts: str,
    gap_min: int = 30,
    tiebreak: str | None = None,
    **hot,
) -> DataFrame:
    """Number each user's sessions from 0 in the column ``session_id``.

    A row more than ``gap_min`` minutes after the one before starts a new session,
    counted in whole seconds. Users with very many rows are cut into slices (see
    ``slice_hot``, which takes the ``hot`` arguments); all windows share one shuffle.
    What a slice hands on, its last time and its sessions, is one row per slice.
    """
    order = [ts] if tiebreak is None else [ts, tiebreak]
    rows = slice_hot(df, user, ts, name="_slice", **hot)
    within = Window.partitionBy(user, "_slice").orderBy(*order)
    rows = rows.withColumn("_before", F.lag(ts).over(within))

    def starts(frame: DataFrame, before: str, at: str = ts) -> Column:
        return F.when(seconds_of(frame, at) - seconds_of(frame, before) > gap_min * 60, 1).otherwise(0)

    rows = rows.withColumn("_new", starts(rows, "_before"))
    slices = rows.where("_slice > 0").groupBy(user, "_slice")
    ends = slices.agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.sum("_new").alias("_inside"))
    along = Window.partitionBy(user).orderBy("_slice")
    ends = ends.withColumn("_end", F.lag("_last").over(along))
    ends = ends.withColumn("_fresh", starts(ends, "_end", "_first"))
    earlier = F.sum(F.col("_inside") + F.col("_fresh")).over(along.rowsBetween(Window.unboundedPreceding, -1))
    carry = ends.select(user, "_slice", (F.coalesce(earlier, F.lit(0)) + F.col("_fresh")).alias("_carry"))
    running = F.sum("_new").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = attach(rows.withColumn("_number", running), F.broadcast(carry), [user, "_slice"])
    number = F.col("_number") + F.coalesce("_carry", F.lit(0))
    return numbered.withColumn("session_id", number).select(*df.columns, "session_id")
