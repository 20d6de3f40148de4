"""Fill-in-the-middle: texts cut at two ranks of units that an indexable skip list finds.

The base lane of the list has a node for every unit of the text; every express lane has
about one of ``SPREAD`` nodes of the lane below. A link carries two widths: how many
units and how many code points it leaps over. A search goes along the top lane while the
units leapt so far do not exceed the rank, then one lane down, and so on; where it ends
on the base lane, the accumulated code points are the place of the cut, exactly.

Which nodes rise to a lane is a hash of the node's number, the same for every text, so
that results do not depend on chance and a worker computes the heights once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.llm.common import chunks, mixed, sliced

#: A node of a lane rises to the next with a chance of one in so many.
SPREAD = 16
#: Code points as units; any other unit is a pattern, see ``unit_widths``.
POINTS = "points"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of text that are handled at once.
PART = 1 << 22
#: Units whose heights are drawn at once.
DRAWN = 1 << 16

_HEIGHTS = np.zeros(0, np.uint8)


def heights(n: int) -> np.ndarray:
    """How many express lanes the nodes 0 .. n-1 rise to; kept by the worker."""
    global _HEIGHTS
    if len(_HEIGHTS) < n:
        parts = [_HEIGHTS]
        for at in range(len(_HEIGHTS), n, DRAWN):
            draw = mixed(np.arange(at + 1, at + DRAWN + 1, dtype=np.uint64))
            height, step = np.zeros(DRAWN, np.uint8), np.uint64(SPREAD)
            rises = np.ones(DRAWN, bool)
            while rises.any():
                rises &= draw % step == 0
                height += rises
                draw = draw // step
                rises &= draw > 0
            parts.append(height)
        _HEIGHTS = np.concatenate(parts)
    return _HEIGHTS[:n]


class SkipList:
    """Units of a text by rank. ``points`` are the code points of each unit, in order."""

    def __init__(self, points: np.ndarray) -> None:
        n = len(points)
        #: For each lane from the base up: units and code points of the link that leaves a node, and the node's place in the lane below.
        self.units: list[np.ndarray | None] = [None]
        self.points = [points]
        self.below: list[np.ndarray | None] = [None]
        self.size = n
        rank, height, lane = None, heights(n), 1
        while True:
            up = np.flatnonzero((height if rank is None else height[rank]) >= lane)
            # The first node stands for the head of the list and rises to every lane.
            if not len(up) or up[0] != 0:
                up = np.concatenate(([0], up))
            if n <= 1 or len(up) == 1:
                return
            rank = up if rank is None else rank[up]
            self.below.append(up)
            self.units.append(np.diff(rank, append=n))
            self.points.append(np.add.reduceat(self.points[-1], up, dtype=np.int64))
            lane += 1

    def place(self, rank: int) -> int:
        """Code points before the unit of this rank; with as many units as there are, all."""
        node, units, points = 0, 0, 0
        for lane in range(len(self.points) - 1, -1, -1):
            wide, long = self.units[lane], self.points[lane]
            end = len(long)
            while node < end:
                width = 1 if wide is None else int(wide[node])
                if units + width > rank:
                    break
                units += width
                points += int(long[node])
                node += 1
            if node == end:
                return points
            if lane:
                node = int(self.below[lane][node])
        return points


def unit_widths(text: str, unit: str) -> np.ndarray:
    """Code points of the units of a text: matches of the pattern ``unit`` from left to right.

    What stands between two matches belongs to the second, what follows the last to it.
    A text without a match is one unit; empty matches are no units.
    """
    if unit == POINTS:
        return np.ones(len(text), np.uint8)
    ends = np.fromiter((m.end() for m in re.finditer(unit, text) if m.end() > m.start()), np.int64)
    if not len(ends):
        return np.array([len(text)] if text else [], np.int64)
    ends[-1] = len(text)
    return np.diff(ends, prepend=0)


def draws(doc_id: int | None) -> list[int]:
    """The first four groups of eight hexadecimal digits of the hash of an id; null is hashed like an empty id."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4]) for i in (0, 4, 8, 12)]


def arrange(text: str, doc_id: int | None, unit: str, plain: int, spm: int) -> tuple[int, str, int | None, int | None, str]:
    """Number of units, form, code points of prefix and middle, and output."""
    widths = unit_widths(text, unit)
    h1, h2, h3, h4 = draws(doc_id)
    n = len(widths)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= 100 - plain:
        return n, "plain", None, None, text
    units = SkipList(widths)
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    lo, hi = units.place(first), units.place(last)
    prefix, middle, suffix = text[:lo], text[lo:hi], text[hi:]
    if h4 % 100 < spm:
        return n, "spm", lo, hi - lo, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", lo, hi - lo, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore(output: str, form: str) -> str:
    """The text that ``arrange`` was given."""
    if form == "plain":
        return output
    # No text of these forms holds a mark, nor can the end of a part and a mark make another mark: the first ones are the marks.
    second = SUFFIX if form == "psm" else PREFIX
    one, rest = output[len(PREFIX) :].split(second, 1)
    other, middle = rest.split(MIDDLE, 1)
    prefix, suffix = (one, other) if form == "psm" else (other, one)
    return prefix + middle + suffix


MADE = "n long, form string, prefix_chars long, middle_chars long, output string"


def _transform(unit: str, plain: int, spm: int, restored: bool):
    names = [c.split()[0] for c in MADE.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
            for lo, hi in chunks(lengths, PART):
                part = batch.slice(lo, hi - lo)
                ids, texts = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
                rows = [arrange(t or "", i, unit, plain, spm) for i, t in zip(ids, texts, strict=True)]
                made = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
                columns, titles = [*part.columns, *made], [*part.schema.names, *names]
                if restored:
                    columns.append(pa.array([restore(r[4], r[1]) for r in rows], pa.string()))
                    titles.append("restored")
                yield pa.RecordBatch.from_arrays(columns, names=titles)

    return run


def fill_in_middle(docs: DataFrame, unit: str = POINTS, plain: int = 10, spm: int = 20, restored: bool = False) -> DataFrame:
    """The columns of ``docs`` (doc_id, text) with ``n`` units, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    ``plain`` percent of the texts stay as they are, and so do empty ones and those that
    hold a mark; ``spm`` percent of the others put the suffix first. All choices are
    hashes of the id. ``restored`` adds the text as rebuilt from output and form.

    A null text is empty and stays plain; a null id is hashed like an empty one.
    Repeated rows get equal results. Columns of the same names are replaced, others stay.
    """
    given = docs.drop("n", "form", "prefix_chars", "middle_chars", "output", *["restored"] * restored)
    given = given.withColumn("text", F.col("text").cast("string"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema)
    return given.mapInArrow(_transform(unit, plain, spm, restored), f"{schema}, {MADE}" + ", restored string" * restored)


def _restore(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        rows = zip(batch.column("output").to_pylist(), batch.column("form").to_pylist(), strict=True)
        texts = pa.array([None if o is None or f is None else restore(o, f) for o, f in rows], pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, "restored"])


def restore_texts(df: DataFrame) -> DataFrame:
    """The columns of ``df`` (output, form) with ``restored``; null where output or form is."""
    given = df.drop("restored")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema)
    return given.mapInArrow(_restore, f"{schema}, restored string")
