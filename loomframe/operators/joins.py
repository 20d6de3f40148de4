"""Joins beyond a single ``DataFrame.join`` call."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.operators.aggs import salt
from loomframe.operators.layout import hot_hashes


#: Copies of a key of the right side that may travel to its task.
COPIES = 16
#: Cells of a key filter: what is broadcast has at most so many rows of 8 bytes, whatever the data.
CELLS = 1 << 20
#: Blocks that a key of ``pairs`` is cut into at most: so often a row travels, once more for its own block.
BLOCKS = 64


def without(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``left`` whose key ``right`` does not hold.

    The keys of ``right`` are first made distinct but for ``COPIES`` of each, so a key that
    fills ``right`` hardly travels. That takes a shuffle of its own: an aggregate on the
    very key would share the join's shuffle, and adaptive execution could then no longer
    split a key that fills ``left``.
    """
    on = [on] if isinstance(on, str) else on
    return left.join(_few_copies(right, on), on, "left_anti")


def _few_copies(right: DataFrame, on: list[str]) -> DataFrame:
    copy = F.pmod(F.spark_partition_id(), F.lit(COPIES)).alias("_copy")
    return right.select(*on, copy).distinct().drop("_copy")


def key_filter(keys: DataFrame, on: list[str], cells: int = CELLS) -> DataFrame:
    """The cells of a hash table of ``cells`` places that some key falls into, in ``_cell``: a filter with one hash.

    Built by a partial aggregate in each task. It has at most ``cells`` rows, so it may
    always be broadcast; more keys than that only make it let more through.
    """
    return keys.select(_cell(on, cells).alias("_cell")).distinct()


def _cell(on: list[str], cells: int) -> Column:
    return F.pmod(F.xxhash64(*on), F.lit(cells))


def reduced_join(
    big: DataFrame, small: DataFrame, on: str | list[str], how: str = "inner", cells: int = CELLS
) -> DataFrame:
    """Join in which rows of ``big`` without a partner mostly go in the scan, before they are shuffled.

    A ``key_filter`` of ``small`` decides. It lets every row with a partner through and a few
    others, which the join then drops: the rows are those of the plain join. ``how`` is
    inner, left_semi, left or left_anti. In the last two, rows that the filter holds
    back are part of the result as they are; ``big`` is then scanned twice.
    """
    if how not in ("inner", "left_semi", "left", "left_anti"):
        raise ValueError(f"how must be inner, left_semi, left or left_anti, not {how}")
    on = [on] if isinstance(on, str) else on
    # Keys are hashed as one type.
    small = small.withColumns({c: F.col(c).cast(big.schema[c].dataType) for c in on})
    cells_of_small = F.broadcast(key_filter(small, on, cells).withColumn("_held", F.lit(True)))
    placed = big.withColumn("_cell", _cell(on, cells))
    if how in ("inner", "left_semi"):
        return placed.join(cells_of_small, "_cell", "left_semi").drop("_cell").join(small, on, how)
    marked = placed.join(cells_of_small, "_cell", "left").drop("_cell")
    maybe, alone = marked.where("_held").drop("_held"), marked.where("_held is null").drop("_held")
    if how == "left_anti":
        return without(maybe, small, on).unionByName(alone)
    return maybe.join(small, on, "left").unionByName(alone.select(*on, *[c for c in alone.columns if c not in on]), allowMissingColumns=True)


def split_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Equi-join for a ``right`` that was just aggregated on the very keys, and a ``left`` with hot keys.

    Such a join would use the shuffle of the aggregate, which adaptive execution cannot split.
    A hash of the keys as a further key asks for a shuffle of its own.
    """
    on = [on] if isinstance(on, str) else on
    right = right.withColumns({c: F.col(c).cast(left.schema[c].dataType) for c in on})
    key = F.xxhash64(*on).alias("_hash")
    joined = left.select("*", key).join(right.select("*", key), [*on, "_hash"], how)
    return joined.select(*left.columns, *[c for c in joined.columns if c not in left.columns and c != "_hash"])


def attach(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on equal keys that also matches NULL with NULL, keys kept once."""
    renamed = other.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    return df.join(renamed, reduce(lambda a, b: a & b, same), "left").drop(
        *[f"_key_{k}" for k in keys]
    )


def lookup(fact: DataFrame, dim: DataFrame, on: str | list[str]) -> DataFrame:
    """Add the columns of a dimension, NULL where it has no entry.

    Spark broadcasts the dimension if its size, estimated or seen at run time, is
    below ``spark.sql.autoBroadcastJoinThreshold`` and merges sorted sides
    otherwise, so there is no forced hint here.
    """
    return fact.join(dim, on, "left")


def agg_then_join(
    dim: DataFrame, fact: DataFrame, dim_key: str, fact_key: str, aggs: list[Column]
) -> DataFrame:
    """Aggregate the fact table per key before joining, so few rows are shuffled."""
    per_key = fact.groupBy(fact_key).agg(*aggs)
    return dim.join(per_key, dim[dim_key] == per_key[fact_key]).drop(per_key[fact_key])


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    salts: int = 16,
    how: str = "inner",
    share: float = 1e-3,
    min_rows: int = 1_000_000,
) -> DataFrame:
    """Equi-join in which the rows of hot keys are spread over ``salts`` buckets.

    Adaptive execution splits the hot keys of an inner join by itself; this is for
    what it leaves whole. Keys that seem to hold more than ``share`` of ``big`` in one
    pass of a sketch are spread, and only their rows of ``small`` are repeated, once
    per bucket; spreading one more or less changes nothing in the result. ``how`` is
    inner or left. Rows of ``big`` with a NULL key match nothing and are spread as well.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how}")
    kinds = {c: big.schema[c].dataType for c in on}
    small = small.withColumns({c: F.col(c).cast(kinds[c]) for c in on})
    hashes = hot_hashes(big.select(*on), on, share, min_rows)
    hot = F.broadcast(hashes.select("_hash", F.lit(True).alias("_hot")))
    hashed = F.xxhash64(*on).alias("_hash")
    no_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    left = big.select("*", hashed).join(hot, "_hash", "left").withColumn(
        "_salt", F.when(F.col("_hot") | no_key, salt(big, salts)).otherwise(0)
    )
    last = F.when(F.col("_hot"), F.lit(salts - 1)).otherwise(0)
    right = (
        small.select("*", hashed)
        .join(hot, "_hash", "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
        .drop("_hot", "_hash")
    )
    joined = left.drop("_hot", "_hash").join(right, [*on, "_salt"], how).drop("_salt")
    return joined.select(*big.columns, *[c for c in small.columns if c not in on])


def pairs(
    df: DataFrame,
    by: str,
    item: str,
    value: str | None = None,
    block: int = 2048,
    hot_share: float = 1e-4,
) -> DataFrame:
    """Unordered pairs of different items that share a ``by`` key.

    One row per pair with the smaller item first: ``by``, ``item1``, ``item2``, and
    ``value1``, ``value2`` if a value column is named.

    Keys with up to ``block`` rows are joined to themselves on the key. A larger
    key is cut into blocks of about ``block`` rows and every two blocks meet in a
    join cell of their own, so no task gets more than about ``block ** 2`` pairs of
    one key. There are at most ``BLOCKS`` of them, larger ones if need be, as every row
    goes to the cells of all blocks: what is shuffled grows with the rows, and one
    of 2,080 cells still holds a small part of a key's pairs. For sums over pairs see
    ``windows.pair_sums``, which forms none. Large keys with more than ``hot_share``
    of all rows, of which there are at most ``1 / hot_share``, are told apart by a
    broadcast, so their rows are never brought together. Where there is no large
    key, adaptive execution drops these branches.
    """
    light, sized = by_size(df, by, item, value, block, hot_share)
    a, b = light.alias("a"), light.alias("b")
    same_key = F.col(f"a.{by}") == F.col(f"b.{by}")
    ordinary = a.join(b, same_key & (F.col("a.item") < F.col("b.item"))).select(
        F.col(f"a.{by}").alias(by),
        F.col("a.item").alias("item1"),
        F.col("b.item").alias("item2"),
        *([F.col("a.value").alias("value1"), F.col("b.value").alias("value2")] if value else []),
    )
    return ordinary.unionAll(pairs_of_large(sized, by, value is not None, block))


def by_size(
    df: DataFrame, by: str, item: str, value: str | None, block: int, hot_share: float = 1e-4
) -> tuple[DataFrame, DataFrame]:
    """The rows ``by``, ``item``, ``value`` of keys with up to ``block`` rows, and those of larger keys with their number ``_n``."""
    cols = {by: F.col(by), "item": F.col(item)} | ({"value": F.col(value)} if value else {})
    rows = df.select(*[c.alias(n) for n, c in cols.items()])
    rows = rows.where(F.col(by).isNotNull() & F.col("item").isNotNull())
    # The count of all rows, but it needs every column: so the branches share their input's shuffle.
    n_rows = F.count("item")
    if value:
        n_rows = F.count("value") + F.count_if(F.col("value").isNull())
    counts = rows.groupBy(by).agg(n_rows.alias("_n"))
    large = counts.where(F.col("_n") > block)
    hot = large.where(F.col("_n") > counts.agg(F.sum("_n")).scalar() * F.lit(hot_share))
    # An outer join, as an anti-join would be pushed below the shuffle that the branches share.
    marked = rows.join(F.broadcast(hot.withColumnRenamed("_n", "_hot")), by, "left")
    rest = marked.where(F.col("_hot").isNull()).drop("_hot")
    light = rest.join(large, by, "left_anti")
    sized = rest.join(large, by).unionByName(rows.join(F.broadcast(hot), by))
    return light, sized


def pairs_of_large(rows: DataFrame, by: str, with_value: bool, block: int) -> DataFrame:
    """Pairs within keys of ``_n`` rows each, one join cell per two blocks of a key.

    The cells are few bytes but many pairs. A fixed number of partitions and a merge
    join keep adaptive execution, which goes by bytes, from packing them together.
    """
    left, right, cell = _cells_of_large(rows, by, with_value, block)
    in_order = F.col("l_item") < F.col("r_item")
    met = left.join(right.hint("merge"), cell).where((F.col("_lo") < F.col("_hi")) | in_order)

    def ordered(c: str) -> list[Column]:
        first, second = F.col(f"l_{c}"), F.col(f"r_{c}")
        return [
            F.when(in_order, first).otherwise(second).alias(f"{c}1"),
            F.when(in_order, second).otherwise(first).alias(f"{c}2"),
        ]

    kept = ["item", "value"] if with_value else ["item"]
    return met.select(by, *[c for name in kept for c in ordered(name)])


def _cells_of_large(rows: DataFrame, by: str, with_value: bool, block: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """The two sides of the join cells, with every row in one of them for each block of its key, and the key of a cell."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = F.least(F.ceil(F.col("_n") / block), F.lit(BLOCKS)).cast("int")
    mine = F.pmod(F.xxhash64("item"), blocks).cast("int")
    placed = rows.withColumns({"_mine": mine, "_last": blocks - 1})

    kept = ["item", "value"] if with_value else ["item"]
    cell = [by, "_lo", "_hi"]

    def side(prefix: str, cells: Column, lo: str, hi: str) -> DataFrame:
        named = [F.col(c).alias(f"{prefix}_{c}") for c in kept]
        found = placed.select(by, *named, "_mine", F.explode(cells).alias("_other"))
        return found.withColumnsRenamed({lo: "_lo", hi: "_hi"}).repartition(partitions, *cell)

    # A row is on the left in the cells from its own block up and on the right in those down to it.
    left = side("l", F.sequence("_mine", "_last"), "_mine", "_other")
    right = side("r", F.sequence(F.lit(0), F.col("_mine")), "_other", "_mine")
    return left, right, cell
