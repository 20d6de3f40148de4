"""Helpers that the operators share: intermediate tables, word hashes, whole groups of sorted batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from loomframe.sinks.files import scratch_dir

#: White space between words: space and the control characters 9 to 13.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Lower case for A to Z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Multiplier of polynomial hashes; odd, so that it has an inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the folder that all executors share and read again: a cut of the lineage that survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit word over all others (a finalizer of multiplications and shifts)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to the power 0 .. n-1 modulo 2^64; kept by the worker."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        _POWERS[base] = have = np.multiply.accumulate(have)
    return have[:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums: ``span_hash`` reads the hash of any span from them."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes from ``start`` to ``end``: equal bytes have equal hashes wherever they stand."""
    inverse = powers(INVERSE, len(sums))
    return mixed((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of a byte array."""
    space = SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64), start
    return span_hash(prefix_sums(data), start, end), start


def chunks(lengths: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` bytes each; a longer row stands alone."""
    first, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if total and total + n > limit:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(lengths):
        yield first, len(lengths)


def pack_texts(*keys: str):
    """A function for ``mapInArrow``: the rows' ``keys`` and their compressed ``text``, for a shuffle of texts."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in sliced(batches):
            packed = [packer.compress(t) for t in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*map(batch.column, keys), pa.array(packed, pa.binary())], names=[*keys, "packed"])

    return pack


def sliced(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, so that a task holds few texts as objects; memory goes back at the end."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str], limit: int = 0) -> Iterator[pa.Table]:
    """Tables of complete groups from batches that are sorted by ``keys``; only the last group is held back.

    ``limit`` gathers batches until they have that many rows.
    """
    held: list[pa.RecordBatch] = []
    rows = 0

    def cut(table: pa.Table) -> int:
        """Where the last group of a table begins."""
        last, at = table.num_rows - 1, 0
        for key in keys:
            column = table.column(key).combine_chunks()
            values = column.to_numpy(zero_copy_only=False) if not isinstance(column, pa.ChunkedArray) else column.to_numpy()
            other = np.flatnonzero(values != values[last])
            at = max(at, int(other[-1]) + 1 if len(other) else 0)
        return at

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < limit:
            continue
        table = pa.Table.from_batches(held)
        at = cut(table)
        if at:
            yield table.slice(0, at).combine_chunks()
            held = table.slice(at).to_batches()
            rows = table.num_rows - at
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def group_bounds(*columns: np.ndarray) -> np.ndarray:
    """Start of each run of equal rows, and the number of rows at the end."""
    n = len(columns[0])
    new = np.zeros(n + 1, bool)
    new[0] = new[n] = True
    for c in columns:
        new[1:n] |= c[1:] != c[:-1]
    return np.flatnonzero(new)
