"""How rows lie over partitions and keys."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def partition_profile(df: DataFrame) -> DataFrame:
    """Number of rows in each partition that has any."""
    return df.select(F.spark_partition_id().alias("partition")).groupBy("partition").agg(
        F.count("*").alias("n_rows")
    )


def key_skew(df: DataFrame, keys: list[str], k: int = 10) -> DataFrame:
    """The ``k`` most frequent keys with their share of all rows."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    share = F.col("n_rows") / counts.agg(F.sum("n_rows")).scalar()
    return counts.withColumn("share", share).orderBy(F.desc("n_rows"), *keys).limit(k)


#: Least share that ``hot_keys`` can tell: below it the sketch would have to track more items than Spark allows.
LEAST_SHARE = 2e-5


def hot_keys(
    df: DataFrame,
    keys: list[str],
    share: float = 1e-4,
    min_rows: int = 1_000_000,
    extra: tuple[Column, ...] = (),
) -> DataFrame:
    """Keys with more than ``share`` of all rows and more than ``min_rows`` rows.

    At most ``1 / share`` keys can qualify, whatever the data, so the result may
    always be broadcast; ``share`` is at least ``LEAST_SHARE``. ``extra`` are further
    aggregates to return per key.

    A frequent-items sketch of fixed size finds candidates without shuffling the
    keys. Its error is below a fifth of ``share``, so it misses no hot key, and the
    candidates are then counted exactly: the result does not depend on the sketch.
    """
    if not LEAST_SHARE <= share <= 1:
        raise ValueError(f"share must be from {LEAST_SHARE} to 1, not {share}")
    limit = F.greatest(F.lit(float(min_rows)), F.col("_all") * share)
    counts = (
        df.withColumn("_hash", F.xxhash64(*keys))
        .join(F.broadcast(hot_hashes(df, keys, share, min_rows)), "_hash")
        .groupBy(*keys)
        .agg(F.count("*").alias("_rows"), F.max("_all").alias("_all"), *extra)
    )
    return counts.where(F.col("_rows") > limit).drop("_rows", "_all")


def hot_hashes(df: DataFrame, keys: list[str], share: float, min_rows: int) -> DataFrame:
    """Hashes of keys that may be hot, from one pass with a sketch; ``_all`` is the number of all rows.

    It holds every hot key and may hold others, at most ``2 / share`` in all. That is enough
    where splitting a key changes nothing in the result.
    """
    hashed = f"xxhash64({', '.join(f'`{k}`' for k in keys)})"
    sketch = F.expr(f"approx_top_k({hashed}, {int(2 / share)}, {int(20 / share)})")
    seen = df.agg(sketch.alias("_top"), F.count("*").alias("_all"))
    limit = F.greatest(F.lit(float(min_rows)), F.col("_all") * share)
    return (
        seen.select(limit.alias("_limit"), "_all", F.explode("_top").alias("_top"))
        .where(F.col("_top.count") * 2 > F.col("_limit"))
        .select(F.col("_top.item").alias("_hash"), "_all")
    )


@contextmanager
def reused(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a result for several actions inside a ``with`` block, then release it.

    What an executor takes down with it is computed again from the lineage.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
