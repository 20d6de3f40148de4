"""Whitening of embeddings on their first principal components by Chebyshev-filtered subspace iteration.

The covariance V of the vectors is never formed. A pass over the data multiplies it with
a narrow block Q: every task adds up its share of Xᵀ(XQ) over centred rows and Spark
sums the shares. A three-term recurrence of such passes applies a Chebyshev polynomial
of V to the block. The polynomial is at most 1 on the unwanted part of the spectrum and
grows fast above it, so that the unwanted part is damped. QR makes the block orthonormal
again and Rayleigh-Ritz finds the best eigenpairs in its span. Rounds are repeated until
the residuals ``|Vu - eu|`` of the wanted pairs certify them to double precision.

The unwanted interval is read off the block: it ends at the smallest Ritz value and
begins as far below the mean of the eigenvalues outside of the block (the trace is
known) as it ends above it, or at the lowest Ritz value ever seen.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.llm.cells import finite, matrix
from loomframe.llm.common import kept, sliced

#: Columns of the block besides the wanted ones: the more, the wider the gap and the fewer the passes.
SPARE = 20
#: Passes of a round.
DEGREE = 8
#: A pair is certified when its residual is below this part of the largest eigenvalue.
CERTIFIED = 2e-14
#: Rounding may keep residuals above that; after rounds without progress this much is accepted.
ACCEPTED = 1e-10
ROUNDS = 60
#: Bytes of vectors that one row of the packed fit list holds.
PACKED = 1 << 20


@dataclass(frozen=True)
class Whitening:
    """``vectors`` (dimensions x components) with falling ``values``; sums and number of the fit list and its trace."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    residual: float
    identity_error: float


def whole(vector: Column, dimensions: int | None = None) -> Column:
    """Components times 256, rounded down, as whole numbers; filled up with zeros to ``dimensions``."""
    made = F.transform(vector, lambda c: F.floor(256 * c.cast("double")).cast("long"))
    if dimensions is None:
        return made
    missing = F.array_repeat(F.lit(0).cast("long"), F.greatest(F.lit(dimensions) - F.size(vector), F.lit(0)))
    return F.concat(made, missing)


def _pack(dimensions: int):
    rows = max(1, PACKED // (8 * max(1, dimensions)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, rows):
            x = matrix(batch.column("x"), dimensions, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary())], names=["x"])

    return run


def _sums(dimensions: int):
    """``place``, ``total`` of each dimension; the number of vectors at place -1, the sum of squares at place -2."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, squares, sums = 0, 0, [0] * dimensions
        for batch in batches:
            for block in batch.column("x"):
                x = np.frombuffer(block.as_buffer(), np.int64).reshape(-1, dimensions)
                n += len(x)
                exact = x if not x.size or len(x) * float(np.abs(x.astype(float)).max()) ** 2 * dimensions < 2.0**62 else x.astype(object)
                sums = [a + int(b) for a, b in zip(sums, exact.sum(axis=0), strict=True)]
                squares += int((exact * exact).sum())
        if n:
            totals = pa.array([str(t) for t in [*sums, n, squares]])
            yield pa.RecordBatch.from_arrays([pa.array([*range(dimensions), -1, -2], pa.int32()), totals], names=["place", "total"])

    return run


def _product(block: np.ndarray, mean: np.ndarray, centre: bool):
    """Shares of the product of centred rows, transposed, with what ``block`` makes of them, entry by entry."""
    dimensions = len(mean)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for packed in batch.column("x"):
                x = np.frombuffer(packed.as_buffer(), np.int64).reshape(-1, dimensions) - mean
                y = x @ block
                if centre:
                    share = x.T @ y
                else:
                    share = np.vstack([y.T @ y, y.sum(axis=0)])
                total = share if total is None else total + share
        if total is not None:
            flat = total.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["place", "value"])

    return run


def _summed(blocks: DataFrame, shares: Callable, shape: tuple[int, int]) -> np.ndarray:
    """Sums of the shares of all tasks: as many numbers as the block has, whatever the number of rows."""
    rows = blocks.mapInArrow(shares, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    out = np.zeros(shape[0] * shape[1])
    for r in rows.collect():
        out[r.place] = r.value
    return out.reshape(shape)


def eigenpairs(apply: Callable[[np.ndarray], np.ndarray], dimensions: int, trace: float, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``k`` largest eigenvalues, their unit vectors and the largest residual relative to the first value.

    ``apply`` multiplies the matrix, symmetric and without negative eigenvalues, with a block.
    """
    width = min(dimensions, k + SPARE)
    wanted = min(k, dimensions)
    start = np.random.default_rng(0).standard_normal((dimensions, width))
    q = np.linalg.qr(start)[0] if width < dimensions else np.eye(dimensions)
    lowest, worst, stuck = np.inf, np.inf, 0
    for _ in range(ROUNDS):
        z = apply(q)
        h = q.T @ z
        values, turn = np.linalg.eigh((h + h.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, z = q @ turn, z @ turn
        scale = max(values[0], np.finfo(float).tiny)
        residual = float(np.linalg.norm(z[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max() / scale)
        stuck = stuck + 1 if residual > worst / 2 else 0
        worst = min(worst, residual)
        if residual <= CERTIFIED or width == dimensions or (stuck >= 2 and residual <= ACCEPTED):
            return values[:wanted], q[:, :wanted], residual
        # The recurrence on the unwanted interval, scaled by its value at the largest Ritz value.
        end = max(values[-1], 0.0)
        lowest = min(lowest, end)
        outside = max(trace - values.sum(), 0.0) / (dimensions - width)
        begin = min(max(2 * outside - end, 0.0), lowest)
        half, centre = max((end - begin) / 2, scale * 1e-12), (end + begin) / 2
        first = sigma = half / max(values[0] - centre, half)
        before, now = q, (z - centre * q) * (sigma / half)
        for _ in range(DEGREE - 1):
            after = 1 / (2 / first - sigma)
            before, now = now, (apply(now) - centre * now) * (2 * after / half) - before * (sigma * after)
            sigma = after
        q = np.linalg.qr(now / np.maximum(np.linalg.norm(now, axis=0), np.finfo(float).tiny))[0]
    raise RuntimeError(f"no eigenpairs to double precision within {ROUNDS} rounds: residual {worst}")


def fit(vectors: DataFrame, k: int = 4) -> Whitening | None:
    """Components of the distinct ones of ``x`` (whole numbers, all of one length); None where there is no vector.

    Each distinct vector counts once, however many rows hold it. Components whose
    eigenvalue is zero but for rounding are left out, so there may be fewer than ``k``.
    """
    dimensions = vectors.agg(F.max(F.size("x"))).first()[0]
    if dimensions is None:
        return None
    blocks = kept(vectors.select("x").distinct().mapInArrow(_pack(dimensions), "x binary"), "fit-list")
    exact = F.sum(F.col("total").cast("decimal(38,0)"))
    totals = blocks.mapInArrow(_sums(dimensions), "place int, total string").groupBy("place").agg(exact.alias("total"))
    found = {r.place: int(r.total) for r in totals.collect()}
    n, squares, sums = found[-1], found[-2], [found[i] for i in range(dimensions)]
    trace = (n * squares - sum(s * s for s in sums)) / (n * n)
    none = Whitening(n, sums, trace, np.zeros(0), np.zeros((dimensions, 0)), 0.0, 0.0)
    if trace <= 0:
        return none
    mean = np.array([s / n for s in sums])

    def apply(block: np.ndarray) -> np.ndarray:
        return _summed(blocks, _product(block, mean, True), block.shape) / n

    values, q, residual = eigenpairs(apply, dimensions, trace, k)
    real = int((values > trace * 1e-13).sum())
    if not real:
        return none
    values, q = values[:real], q[:, :real]
    moments = _summed(blocks, _product(q / np.sqrt(values), mean, False), (real + 1, real)) / n
    covariance = moments[:real] - np.outer(moments[real], moments[real])
    error = float(np.abs(covariance - np.eye(real)).max())
    return Whitening(n, sums, trace, values, q, residual, error)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the dimensions of ``(n * x - S)^2``, exact; None where it is above what a long holds."""
    most = max([abs(s) for s in sums], default=0)
    widest = n * float(np.abs(x.astype(float)).max(initial=0)) + most
    if widest * widest * max(1, x.shape[1]) < 2.0**62:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    found = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1).tolist()
    return [int(d) if d < 1 << 63 else None for d in found]


def _whiten(model: Whitening, dimensions: int):
    scaled = model.vectors / np.sqrt(model.values)
    mean = np.array([s / model.n for s in model.sums])
    count = len(model.values)
    shares = model.values / model.trace

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2000):
            x = matrix(batch.column("x"), dimensions, np.int64)
            white = (x - mean) @ scaled
            deviation = pa.array(_deviations(x, model.n, model.sums), pa.int64())
            row = pa.array(np.repeat(np.arange(len(x)), count))
            columns = [
                batch.column("vec_id").take(row),
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(x) * count, model.n, np.int64)),
                deviation.take(row),
                pa.array(white.ravel()),
                pa.array(np.tile(shares, len(x))),
                pa.array(np.full(len(x) * count, model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=WHITENED)

    return run


WHITENED = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def whitened(vectors: DataFrame, k: int = 4) -> DataFrame:
    """Every usable row of ``vectors`` (vec_id, vector) on each of the first ``k`` components of unit variance.

    ``explained`` is a component's share of the trace; ``identity_error`` is how far
    the covariance of the whitened fit list is from the identity, one value for all rows.

    Rows whose vector is null or holds a null or non-finite component are left out.
    Shorter vectors, empty ones too, are filled up with zeros. Repeated rows come out
    repeatedly but count once in the fit; null ids stay; other columns are ignored.
    Components without variance are left out, so a table of equal vectors has no rows.
    ``deviation`` is null where it does not fit into a long.
    """
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    good = vectors.where(F.col("vector").isNotNull() & F.coalesce(finite(F.col("vector")), F.lit(False)))
    dimensions = good.agg(F.max(F.size("vector"))).first()[0]
    if not dimensions:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = good.select("vec_id", whole(F.col("vector"), dimensions).alias("x"))
    model = fit(rows, k)
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], schema)
    return rows.mapInArrow(_whiten(model, dimensions), schema)
