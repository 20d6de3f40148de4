"""Exact top-k inner products of integer vectors.

Vectors are ordered by descending length and cut into blocks. The block of the longest
vectors gives every query a score that its k-th best reaches at least; blocks whose
longest vector cannot reach it (Cauchy-Schwarz) are never visited. Within a block,
vectors and queries are rotated by the singular vectors of all data, so that the first
components carry most of an inner product: their partial sum and the lengths of what
remains bound it from above, and only pairs whose bound reaches the score are computed,
in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.llm.cells import best, distinct_rows, first_k, matrix, searched
from loomframe.llm.common import kept
from loomframe.operators.joins import split_join

#: Vectors of a block at least, blocks at most, and vectors of a step within a block.
BLOCK = 4096
BLOCKS = 1 << 16
STEP = 512
#: Queries that are compared with a step at once.
TILE = 512
#: Rotated components of a partial sum, as a share of all.
LEADING = 0.25


def _moments(dimensions: int):
    """Sums of products of components, as (place, value) rows."""

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dimensions, dimensions))
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("vector"), dimensions)
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["place", "value"])

    return sums


def rotation(vectors: DataFrame, dimensions: int) -> np.ndarray:
    """Right singular vectors of all rows, the strongest first."""
    cells = vectors.mapInArrow(_moments(dimensions), "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
    moments = np.zeros(dimensions * dimensions)
    for place, value in cells.collect():  # dimensions x dimensions numbers
        moments[place] = value
    _, axes = np.linalg.eigh(moments.reshape(dimensions, dimensions))
    return axes[:, ::-1]


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of all rows, exact: in doubles where no partial sum can leave the whole numbers they hold."""
    widest = np.abs(queries.astype(float)).max(initial=0) * np.abs(vectors.astype(float)).max(initial=0) * queries.shape[1]
    if widest < 2.0**53:
        return (queries.astype(float) @ vectors.astype(float).T).astype(np.int64)
    return queries @ vectors.T


def _top(k: int, axes: np.ndarray):
    leading = max(1, round(LEADING * len(axes)))

    def find(query_ids, queries, least, ids, vectors):
        order = np.lexsort((ids, -(vectors.astype(float) ** 2).sum(axis=1)))
        turned, asked = vectors[order].astype(float) @ axes, queries.astype(float) @ axes
        rest, asked_rest = (np.sqrt((m[:, leading:] ** 2).sum(axis=1)) for m in (turned, asked))
        # Sums of rounding errors stay far below this.
        slack = 1 + 1e-9 * np.sqrt((asked**2).sum(axis=1)) * np.sqrt((turned**2).sum(axis=1).max())
        turned, asked = turned[:, :leading].copy(), asked[:, :leading].copy()
        bar = np.where(np.isnan(least.astype(float)), -np.inf, least.astype(float))
        found = []
        for first in range(0, len(queries), TILE):
            tile = slice(first, first + TILE)
            best_so_far = np.full((len(queries[tile]), k), -np.inf)
            own: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for lo in range(0, len(ids), STEP):
                at = order[lo : lo + STEP]
                bound = asked[tile] @ turned[lo : lo + STEP].T + np.outer(asked_rest[tile], rest[lo : lo + STEP])
                open_pairs = (bound + slack[tile, None] >= bar[tile, None]) & (query_ids[tile, None] != ids[None, at])
                rows, columns = np.flatnonzero(open_pairs.any(axis=1)), np.flatnonzero(open_pairs.any(axis=0))
                if not len(rows):
                    continue
                part = np.ix_(rows, columns)
                exact = _products(queries[tile][rows], vectors[at[columns]])
                scores = np.where(open_pairs[part], exact, -np.inf)
                joined = np.concatenate([best_so_far[rows], scores], axis=1)
                best_so_far[rows] = np.partition(joined, joined.shape[1] - k, axis=1)[:, -k:]
                bar[tile] = np.maximum(bar[tile], best_so_far[:, 0])
                q, v = np.nonzero(scores >= np.maximum(bar[tile][rows], np.iinfo(np.int64).min)[:, None])
                own.append((rows[q], at[columns[v]], exact[q, v]))
            if own:
                q, v, score = (np.concatenate(x) for x in zip(*own, strict=True))
                good = first_k(q, ids[v], -score, k)
                found.append((q[good] + first, v[good], score[good]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    return lambda: find


def _last_block(longest: np.ndarray):
    """The last block that can hold a vector with a score of ``least``, by length alone; blocks come by falling length."""

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            least = batch.column("least").to_numpy(zero_copy_only=False).astype(float)
            # Cauchy-Schwarz: length * longest >= least, with room for rounding.
            needed = np.divide(least - 1, length * (1 + 1e-9), out=np.where(least > 1, np.inf, -np.inf), where=length > 0)
            last = np.where(np.isnan(least), len(longest), np.searchsorted(-longest, -needed, side="right")) - 1
            columns = [batch.column(c) for c in ("vec_id", "vector", "copies", "row", "least")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(last.astype(np.int32))], names=[*LED, "last"])

    return place


LED = ["vec_id", "vector", "copies", "row", "least"]


def top_inner_products(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` highest inner products of each query.

    Both inputs have ``vec_id`` and ``vector`` (array of whole numbers); the result
    is exact. A query never finds its own id; ties go to the smaller id. With fewer
    candidates than ``k`` all are returned.

    Vectors that are null or hold null components take no part, and neither do null
    ids. Every row is a candidate of its own, also where rows have equal ids or are
    equal; queries of one id share ``k`` ranks for what any of them finds. Shorter
    vectors are filled up with zeros, and a vector of zeros scores 0. Other columns
    are ignored. Empty inputs give an empty result.
    """
    spark = vectors.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        whole = F.col("vector").cast("array<long>")
        return distinct_rows(df.select("vec_id", whole.alias("vector")), F.forall("vector", lambda x: x.isNotNull()))

    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x))
    data = kept(clean(vectors).withColumn("length", length), "vectors")
    asks = kept(clean(queries).withColumn("length", length), "queries")
    count, dimensions = data.agg(F.count("*"), F.max(F.size("vector"))).first()
    if not count or asks.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dimensions = max(1, dimensions, asks.agg(F.max(F.size("vector"))).first()[0])
    axes = rotation(data, dimensions)
    number = max(1, min(BLOCKS, -(-count // BLOCK)))
    blocks = data.repartitionByRange(number, F.desc("length"), "vec_id", "row")
    blocks = kept(blocks.withColumn("part", F.spark_partition_id()), "blocks")
    # At most BLOCKS rows of numbers.
    longest = sorted(blocks.groupBy("part").agg(F.max("length"), F.count("*")).collect())
    first = next((i for i, (_, _, n) in enumerate(longest) if n > k), 0)
    # Blocks are numbered in a row, by falling length.
    numbers = spark.createDataFrame([(part, i) for i, (part, _, _) in enumerate(longest)], "part int, block int")
    blocks = blocks.join(F.broadcast(numbers), "part").select("block", "vec_id", "vector", "copies", "row").withColumnRenamed("block", "part")

    lead = asks.select(F.lit(first).alias("part"), "vec_id", "vector", "copies", "row", F.lit(None).cast("long").alias("least"))
    head = blocks.where(F.col("part") == first)
    opening = kept(searched(head, lead, ["part"], _top(k, axes), dimensions, "long"), "opening")
    reached = best(opening, k, highest=True).where(F.col("rank") == k)
    # Every query of an id has the bar of the id: only what reaches it can be among the id's k best.
    bars = reached.select(F.col("query_id").alias("vec_id"), F.col("score").alias("least"))
    lengths = np.array([length for _, length, _ in longest], float)
    placed = split_join(asks, bars, "vec_id", "left").mapInArrow(
        _last_block(lengths), "vec_id long, vector array<long>, copies long, row long, least long, last int"
    )
    others = (
        placed.where("last >= 0")
        .withColumn("part", F.explode(F.sequence(F.lit(0), "last")))
        .where(F.col("part") != first)
        .select("part", *LED)
    )
    rest = blocks.where(F.col("part") != first)
    found = searched(rest, others, ["part"], _top(k, axes), dimensions, "long")
    return best(opening.unionByName(found), k, highest=True)
