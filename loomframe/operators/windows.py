"""Ranked, running and rolling measures per group.

A window function works on one group in one task. ``slice_hot`` cuts groups that
hold a large part of all rows into ranges of the order column; ``previous`` and
``running_sum`` then work per slice and carry the end of each slice over into the
next, with the same result as one window over the whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomframe.functions.numeric import seconds_of
from loomframe.operators.joins import attach
from loomframe.operators.layout import hot_keys
from loomframe.sinks.files import scratch_dir

_RANKS = {"dense": F.dense_rank, "gap": F.rank, "none": F.row_number}


def _ordered(by: list[str], order: list[str]):
    return Window.partitionBy(*by).orderBy(*order)


def top_per_group(
    df: DataFrame,
    by: str,
    order: list[Column],
    n: int = 1,
    ties: str = "dense",
    name: str = "rank",
) -> DataFrame:
    """Rows ranked ``n`` or better in their group.

    ``ties`` is ``dense`` (equal rows share a rank, no gaps), ``gap`` (share, with
    gaps) or ``none`` (numbered through; end the order with a unique column).
    Spark cuts every task's rows at rank ``n`` before they are shuffled.
    """
    rank = _RANKS[ties]().over(Window.partitionBy(by).orderBy(*order))
    return df.withColumn(name, rank).where(F.col(name) <= n)


#: Cut points are looked up in two steps of this size.
STEP = 16


def slice_hot(
    df: DataFrame,
    by: str,
    order: str,
    share: float = 1e-4,
    min_rows: int = 1_000_000,
    name: str = "slice",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Add a slice number: 0 for ordinary groups, 1 and up for parts of hot ones.

    A hot group has more than ``share`` of all rows and more than ``min_rows``. It is
    cut at the 255 quantiles of its own ``order`` values, so that its slices hold about
    equally many rows wherever the values lie; a burst or one odd date costs nothing.
    Slice numbers grow with ``order``. Equal values are never parted, and NULL goes first.

    ``hot`` takes the result of ``hot_cuts``, so that one search serves several calls.
    """
    at = seconds_of(df, order)
    if hot is None:
        hot = hot_cuts(df, by, order, share, min_rows)
    coarse = F.size(F.filter("_coarse", lambda x: x < at))
    fine = F.size(F.filter(F.slice("_cuts", coarse * STEP + 1, STEP - 1), lambda x: x < at))
    number = F.when(F.col("_cuts").isNull(), 0).otherwise(
        F.when(at.isNull(), 1).otherwise(coarse * STEP + fine + 1)
    )
    return attach(df, F.broadcast(hot), [by]).withColumn(name, number.cast("int")).select(*df.columns, name)


def hot_cuts(df: DataFrame, by: str, order: str, share: float = 1e-4, min_rows: int = 1_000_000) -> DataFrame:
    """The hot groups of ``df`` with the quantiles of ``order``: at most ``1 / share`` rows of 2 kB."""
    parts = STEP * STEP
    at = seconds_of(df, order)
    shares = ", ".join(f"{i / parts}D" for i in range(1, parts))
    cuts = F.expr(f"approx_percentile(_at, array({shares}), {20 * parts})")
    rows = df.select(by, at.cast("double").alias("_at"))
    hot = hot_keys(rows, [by], share, min_rows, (cuts.alias("_cuts"),))
    every = F.expr(f"filter(_cuts, (x, i) -> (i + 1) % {STEP} = 0)")
    none = F.array().cast("array<double>")
    return hot.select(by, F.coalesce(every, none).alias("_coarse"), F.coalesce("_cuts", none).alias("_cuts"))


def previous(
    df: DataFrame,
    by: str,
    order: list[str],
    col: str,
    name: str = "previous",
    slice: str | None = None,
) -> DataFrame:
    """Value of ``col`` in the row before, NULL in the first row of a group."""
    if slice is None:
        return df.withColumn(name, F.lag(col, 1).over(_ordered([by], order)))
    last = (
        df.where(F.col(slice) > 0)
        .groupBy(by, slice)
        .agg(F.max_by(col, F.struct(*order)).alias("_last"))
    )
    # One row per slice of a hot group; a value may be of any size, so Spark chooses how to join.
    carry = last.withColumn("_carry", F.lag("_last").over(_ordered([by], [slice]))).drop("_last")
    within = _ordered([by, slice], order)
    return (
        attach(
            df.withColumns({"_before": F.lag(col).over(within), "_row": F.row_number().over(within)}),
            carry,
            [by, slice],
        )
        .withColumn(name, F.when(F.col("_row") == 1, F.col("_carry")).otherwise(F.col("_before")))
        .select(*df.columns, name)
    )


def delta(
    df: DataFrame,
    by: str,
    order: list[str],
    col: str,
    name: str = "difference",
    slice: str | None = None,
) -> DataFrame:
    """Change of ``col`` since the row before, NULL in the first row of a group."""
    with_previous = previous(df, by, order, col, "_previous", slice)
    return with_previous.withColumn(name, F.col(col) - F.col("_previous")).drop("_previous")


def running_sum(
    df: DataFrame,
    by: str,
    order: list[str],
    col: str,
    name: str = "running_total",
    slice: str | None = None,
) -> DataFrame:
    """Sum of ``col`` over the rows of a group up to and including this one.

    ``order`` has to tell any two rows of a group apart.
    """
    groups = [by] if slice is None else [by, slice]
    frame = _ordered(groups, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = df.withColumn(name, F.sum(col).over(frame))
    if slice is None:
        return summed
    totals = df.where(F.col(slice) > 0).groupBy(by, slice).agg(F.sum(col).alias("_total"))
    earlier = _ordered([by], [slice]).rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice of a hot group, a number that slice_hot bounds.
    carry = totals.withColumn("_carry", F.sum("_total").over(earlier)).drop("_total")
    return (
        attach(summed, F.broadcast(carry), [by, slice])
        .withColumn(
            name,
            F.when(F.col("_carry").isNull(), F.col(name)).otherwise(
                F.col("_carry") + F.coalesce(F.col(name), F.lit(0))
            ),
        )
        .select(*df.columns, name)
    )


def pair_sums(
    df: DataFrame,
    by: str,
    item: str,
    sums: dict[str, tuple[Column, Column]],
    share: float = 1e-4,
    min_rows: int = 1_000_000,
) -> DataFrame:
    """Sums over the pairs that ``joins.pairs`` forms, for each ``by`` key, without forming them.

    ``sums`` maps a name to a column of the row with the smaller item and one of the row with
    the larger. Each pair adds their product; (1, 1) counts the pairs. NULL products are
    left out, and a sum without any other is NULL. Keys without a pair do not come out.

    A running sum over the smaller items gives each item what its pairs have in common, so
    the work is that of a sort. Keys that ``slice_hot`` cuts are summed slice by slice, and the
    slices of a key then once more in the same way; ``item`` is a number or a time for that.
    """
    terms = {"_n": (F.lit(1), F.lit(1))}
    for i, (low, high) in enumerate(sums.values()):
        # The second term counts the products that are there.
        terms |= {f"_s{i}": (low, high), f"_c{i}": (low.isNotNull().cast("long"), high.isNotNull().cast("long"))}
    found = F.lit(0).cast("long")
    rows = df.where(F.col(by).isNotNull() & F.col(item).isNotNull())
    # An item that repeats is in no pair with itself.
    sides = [F.coalesce(F.sum(c), F.lit(0)).alias(f"{t}_{s}") for t, two in terms.items() for s, c in zip("lh", two, strict=True)]
    per_item = rows.groupBy(by, item).agg(*sides).withColumns(dict.fromkeys(terms, found))
    cut = slice_hot(per_item, by, item, share, min_rows, "_slice")
    total = _paired(_paired(cut, [by, "_slice"], item, list(terms)), [by], "_slice", list(terms))
    named = [F.when(F.col(f"_c{i}") > 0, F.col(f"_s{i}")).alias(name) for i, name in enumerate(sums)]
    return total.where(F.col("_n") > 0).select(by, *named)


def _paired(rows: DataFrame, groups: list[str], order: str, terms: list[str]) -> DataFrame:
    """One row per group: its sums of both sides, and of the products of each row with the rows before it."""
    before = _ordered(groups, [order]).rowsBetween(Window.unboundedPreceding, -1)
    lower = {f"{t}_before": F.coalesce(F.sum(f"{t}_l").over(before), F.lit(0)) for t in terms}
    inside = [F.sum(F.col(t) + F.col(f"{t}_h") * F.col(f"{t}_before")).alias(t) for t in terms]
    sides = [F.sum(f"{t}_{s}").alias(f"{t}_{s}") for t in terms for s in "lh"]
    return rows.withColumns(lower).groupBy(*groups).agg(*inside, *sides)


def rolling(
    df: DataFrame, by: str, day: str, value: Column, name: str, days: int = 7, slice: str | None = None
) -> DataFrame:
    """An aggregate over the last ``days`` day numbers of a group, this one included.

    Counts days by their number and not by rows, so days may be missing or repeat.
    ``slice`` names the slices that ``slice_hot`` cut by ``day``: every slice of a hot
    group then has a window of its own, and its task also gets the rows of the last days
    before the slice begins. Only a slice's own rows come out, so the result is the same.
    """
    if slice is None:
        recent = _ordered([by], [day]).rangeBetween(1 - days, Window.currentRow)
        return df.withColumn(name, value.over(recent))
    placed = with_overlap(df, by, day, days, slice)
    recent = _ordered([by, "_slice"], [day]).rangeBetween(1 - days, Window.currentRow)
    return placed.withColumn(name, value.over(recent)).where(F.col("_slice") == F.col(slice)).select(*df.columns, name)


def with_overlap(df: DataFrame, by: str, day: str, days: int, slice: str) -> DataFrame:
    """Every row once for its own slice and once for each later one that begins less than ``days`` after it, in ``_slice``."""
    begins = df.where(F.col(slice) > 0).groupBy(by, slice).agg(F.min(day).alias("_first"))
    # At most 256 slices of each hot group, which slice_hot bounds.
    listed = begins.groupBy(by).agg(F.collect_list(F.struct(F.col(slice).alias("slice"), F.col("_first").alias("first"))).alias("_begins"))
    reached = F.filter("_begins", lambda b: (b["slice"] > F.col(slice)) & (b["first"] - F.col(day) < days))
    later = F.when(F.col(slice) > 0, F.transform(reached, lambda b: b["slice"]))
    targets = F.concat(F.array(F.col(slice)), F.coalesce(later, F.array().cast("array<int>")))
    # An outer generator, as the plain one would compute its array beforehand once more, to see that it is not empty.
    return attach(df, F.broadcast(listed), [by]).withColumn("_slice", F.explode_outer(targets)).select(*df.columns, "_slice")


def rolling_mean(
    df: DataFrame, by: str, day: str, col: str, days: int = 7, name: str = "rolling_average", slice: str | None = None
) -> DataFrame:
    """Mean of ``col`` over the last ``days`` day numbers, see ``rolling``.

    Where one day has very many rows see ``rolling_mean_by_day``.
    """
    return rolling(df, by, day, F.avg(col), name, days, slice)


def rolling_mean_by_day(
    df: DataFrame, by: str, day: str, col: str, days: int = 7, name: str = "rolling_average"
) -> DataFrame:
    """The same, from sums per day: what reaches a window is one row per group and day, however many stand behind it."""
    per_day = df.groupBy(by, day).agg(F.sum(col).alias("_sum"), F.count(col).alias("_count"))
    recent = _ordered([by], [day]).rangeBetween(1 - days, Window.currentRow)
    count = F.sum("_count").over(recent)
    mean = F.when(count > 0, F.sum("_sum").over(recent) / count)
    return attach(df, per_day.select(by, day, mean.alias(name)), [by, day])


def global_rank(df: DataFrame, order: dict[str, str], ties: str = "none", name: str = "rank") -> DataFrame:
    """Number or rank every row of a whole table, without bringing its rows together.

    ``order`` maps columns to ``asc`` or ``desc``; NULL is smallest. ``ties`` is as in
    ``top_per_group``. Rows are dealt to tasks by ranges of ``order`` and written to the
    shared folder; a window then works inside each range and adds what the ranges before
    it hold, one number for each task.

    Ranks depend on the order's values alone, so with ``dense`` and ``gap`` only distinct
    values are dealt, each with its number of rows: a value that holds a third of all rows is
    one. With ``none`` equal rows are numbered in any order; they are spread over ranges.
    """
    if ties not in _RANKS:
        raise ValueError(f"ties must be one of {sorted(_RANKS)}, not {ties}")
    sorts = [F.desc(c) if way == "desc" else F.asc(c) for c, way in order.items()]
    if ties == "none":
        spread = F.xxhash64(*df.columns, F.spark_partition_id())
        rows = df.withColumns({"_rows": F.lit(1).cast("long"), "_spread": spread})
        return _ranked_by_ranges(rows, [*sorts, F.asc("_spread")], "dense", name).select(*df.columns, name)
    distinct = df.groupBy(*order).agg(F.count("*").alias("_rows"))
    ranked = _ranked_by_ranges(distinct, sorts, ties, name)
    return attach(df, ranked.select(*order, name), list(order)).select(*df.columns, name)


def _ranked_by_ranges(rows: DataFrame, order: list[Column], ties: str, name: str) -> DataFrame:
    """Rows numbered (``dense``) or with the number of ``_rows`` before them (``gap``), counted from 1."""
    spark = rows.sparkSession
    path = scratch_dir(spark, "ranges")
    # Ranges come from a sample; written once, so that counts and numbers see the same ranges.
    rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.parquet(path)
    size = F.count("*") if ties == "dense" else F.sum("_rows")
    sizes = dealt.groupBy("_range").agg(size.alias("_size"))
    # One entry for each task of the write.
    listed = sizes.agg(F.collect_list(F.struct("_range", "_size")).alias("_all"))
    earlier = F.filter("_all", lambda x: x["_range"] < F.col("_at._range"))
    before = F.aggregate(earlier, F.lit(0).cast("long"), lambda sum, x: sum + x["_size"])
    offsets = listed.select("_all", F.explode("_all").alias("_at")).select(F.col("_at._range").alias("_range"), before.alias("_before"))
    inside = Window.partitionBy("_range").orderBy(*order)
    if ties == "dense":
        number = F.row_number().over(inside)
    else:
        number = F.sum("_rows").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_rows") + 1
    numbered = dealt.withColumn("_inside", number).join(F.broadcast(offsets), "_range")
    return numbered.withColumn(name, (F.col("_inside") + F.col("_before")).cast("long")).drop("_inside", "_before", "_range")
