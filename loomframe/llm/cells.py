"""Searches of a set of queries against all vectors, block by block."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomframe.llm.common import group_bounds, whole_groups

#: Vectors and queries of a cell at most, about.
VECTORS = 4096
QUERIES = 4096

#: From ids and vectors of queries, what their scores have to reach, and ids and vectors of a block: places of queries
#: and vectors of what is found, and its scores.
Search = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def matrix(column: pa.Array, dimensions: int, kind: type = np.float64) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    if (lengths == dimensions).all():
        return flat.reshape(-1, dimensions)
    out = np.zeros((len(column), dimensions), kind)
    out[np.repeat(np.arange(len(column)), lengths), np.concatenate([np.arange(n) for n in lengths] or [[]]).astype(int)] = flat
    return out


def distinct_rows(vectors: DataFrame, usable: Column) -> DataFrame:
    """``vec_id``, ``vector``, ``copies`` and ``row`` of usable vectors: equal rows once, with their number and a hash of the vector."""
    good = vectors.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & F.coalesce(usable, F.lit(False)))
    rows = good.groupBy(F.col("vec_id").cast("long").alias("vec_id"), "vector").agg(F.count("*").alias("copies"))
    return rows.withColumn("row", F.xxhash64("vector"))


def finite(vector: Column) -> Column:
    """Whether no component is null, NaN or infinite."""
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def searched(
    vectors: DataFrame, queries: DataFrame, keys: list[str], search: Callable[[], Search], dimensions: int, score: str
) -> DataFrame:
    """``FOUND``: what ``search`` finds for the queries among the vectors of equal ``keys``.

    ``vectors`` has the keys and the columns of ``distinct_rows``; ``queries`` also ``least``, what a score has to reach.
    Keys with many vectors or queries are cut into cells of one block of each, so that no task holds a whole key.
    """
    sizes = (
        vectors.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .select(*keys, F.ceil(F.col("n") / VECTORS).cast("int").alias("blocks"))
    )
    asked = queries.groupBy(*keys).agg(F.count("*").alias("n"))
    asked = asked.select(*keys, F.ceil(F.col("n") / QUERIES).cast("int").alias("chunks"))
    sizes = sizes.join(asked, keys)

    def numbers(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    rows = vectors.join(sizes, keys).withColumn("block", F.pmod(F.xxhash64("vec_id", "row"), "blocks").cast("int"))
    rows = rows.withColumn("chunk", numbers("chunks")).withColumn("least", F.lit(None).cast(score))
    asks = queries.join(sizes, keys).withColumn("chunk", F.pmod(F.xxhash64("vec_id", "row"), "chunks").cast("int"))
    asks = asks.withColumn("block", numbers("blocks"))
    cell = [*keys, "block", "chunk"]
    columns = [*cell, "vec_id", "row", "copies", "vector", "least"]
    both = rows.select(*columns, F.lit(False).alias("asks")).union(asks.select(*columns, F.lit(True).alias("asks")))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = search()
        for table in whole_groups(batches, cell, 5000):
            ids, row, copies, ask, least = (table.column(c).to_numpy() for c in ("vec_id", "row", "copies", "asks", "least"))
            values = matrix(table.column("vector").combine_chunks(), dimensions, np.int64 if score == "long" else np.float64)
            bounds = group_bounds(*(table.column(c).to_numpy() for c in cell))
            found = []
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                q, v = lo + np.flatnonzero(ask[lo:hi]), lo + np.flatnonzero(~ask[lo:hi])
                if len(q) and len(v):
                    a, b, s = find(ids[q], values[q], least[q], ids[v], values[v])
                    found.append((q[a], v[b], s))
            if found:
                a, b, s = (np.concatenate(x) for x in zip(*found, strict=True))
                columns = [ids[a], row[a], ids[b], row[b], copies[a] * copies[b], s]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=FOUND)

    cells = both.repartition(*cell).sortWithinPartitions(*cell)
    return cells.mapInArrow(run, f"query_id long, query_row long, vec_id long, vec_row long, copies long, score {score}")


#: Columns of what is found: both rows of a pair, how often it stands in the input, and its score.
FOUND = ["query_id", "query_row", "vec_id", "vec_row", "copies", "score"]


def best(found: DataFrame, k: int, highest: bool) -> DataFrame:
    """The first ``k`` of each query id with their rank, equal rows one by one; ties go to the smaller ``vec_id``."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score") if highest else F.asc("score"), "vec_id")
    # Of the pairs as many as there are ranks suffice, and of equal ones too.
    first = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    each = first.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))))
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def first_k(query: np.ndarray, ids: np.ndarray, keys: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` smallest ``keys`` of each query, ties by id."""
    order = np.lexsort((ids, keys, query))
    bounds = group_bounds(query[order]) if len(order) else np.zeros(1, int)
    rank = np.arange(len(order)) - np.repeat(bounds[:-1], np.diff(bounds))
    return order[rank < k]
