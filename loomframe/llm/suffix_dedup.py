"""Removal of long byte strings that occur more than once, by refining buckets of suffixes.

Two equal strings of ``LENGTH`` bytes have the same smallest q-gram (by hash, the
leftmost of equals) at the same offset, their anchor. So only suffixes at anchors are
put in buckets, and a window is judged in the bucket of its anchor alone:

1. Buckets of the q-grams at anchors. A suffix that is alone in its bucket drops out.
2. A bucket is refined by an identifier of all that its anchor's windows span. Suffixes
   that still share a bucket are repeated with all their windows.
3. In buckets that hold different surroundings, one suffix for each surrounding goes on.
   Its buckets of q-grams are refined by the bucket pointers at later offsets, and those
   renewed serve to refine further (25 -> 50 -> 100 -> 200 bytes), which gives the
   bucket of every single window. A bucket with more surroundings than one task should
   hold is refined window by window with a shuffle instead.

Texts are shuffled once, compressed; from then on only documents with a bucket that is
shared take part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.llm.common import chunks, group_bounds, kept, mixed, prefix_sums, sliced, span_hash, whole_groups

LENGTH = 200
GRAM = 25
#: q-grams of a window.
WIDTH = LENGTH - GRAM + 1
#: Windows of a text that are looked at once, and the low bits of a sliding minimum that hold a position among them.
PIECE = 1 << 22
PLACE = 28
#: Surroundings of a bucket that one task compares.
LARGE = 2000
#: Surroundings that are refined at once, whole buckets.
PART = 1000

ANCHORS = "gram long, around long, doc long, at int, left short, right short"
MARK = "lo int, hi int, gram long, at int, settled boolean, surroundings long"


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` values, in linear time."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Bucket of the q-gram, identifier of the surroundings, place, and bytes to the left and right, of every anchor."""
    sums = prefix_sums(data)
    start = np.arange(len(data) - GRAM + 1)
    gram = span_hash(sums, start, start + GRAM)
    place = np.uint64((1 << PLACE) - 1)
    least = sliding_minimum((gram & ~place) | start.astype(np.uint64), WIDTH)
    anchor = (least & place).astype(np.int64)
    bounds = group_bounds(anchor)
    lo, hi = bounds[:-1], bounds[1:] - 1 + LENGTH
    at = anchor[lo]
    around = mixed(span_hash(sums, lo, hi) + (at - lo).astype(np.uint64))
    return gram[at], around, at, at - lo, hi - at


def _anchor_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["gram", "around", "doc", "at", "left", "right"]
    for batch in sliced(batches):
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), strict=True):
            data = np.frombuffer((text or "").encode(), np.uint8)
            if len(data) < LENGTH:
                continue
            # Windows of a longer text are dealt out; an anchor at a border then has two rows, with other windows each.
            for first in range(0, len(data) - LENGTH + 1, PIECE):
                gram, around, at, left, right = anchors(data[first : first + PIECE + LENGTH - 1])
                at = (at + first).astype(np.int32)
                held.append((gram.view(np.int64), around.view(np.int64), np.full(len(at), doc), at, left.astype(np.int16), right.astype(np.int16)))
                size += len(at)
                if size > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names=names)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names=names)


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            packed = [packer.compress((t or "").encode()) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(packed, pa.binary())], names=["doc", "packed"])


def _cut_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The surroundings that go on, cut from their texts."""
    opener = zstandard.ZstdDecompressor()
    names = ["gram", "surroundings", "settled", "doc", "lo", "left", "around"]
    for batch in batches:
        for row in range(0, batch.num_rows, 200):
            part = batch.slice(row, 200)
            found: list[tuple] = []
            for doc, packed, marks in zip(*(part.column(c).to_pylist() for c in ("doc", "packed", "marks")), strict=True):
                text = None
                for m in marks:
                    if m["gram"] is not None:
                        text = opener.decompress(packed) if text is None else text
                        found.append((m["gram"], m["surroundings"], m["settled"], doc, m["lo"], m["at"] - m["lo"], text[m["lo"] : m["hi"]]))
            if found:
                types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                columns = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


CUT_OUT = "gram long, surroundings long, settled boolean, doc long, lo int, left int, around binary"


def _named(*ids: np.ndarray) -> np.ndarray:
    """Bucket numbers of rows: equal rows get equal numbers, in sorted order."""
    order = np.lexsort(ids[::-1])
    new = np.zeros(len(order), np.int64)
    for x in ids:
        s = x[order]
        new[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _pointers(order: np.ndarray, *ids: np.ndarray) -> np.ndarray:
    """Bucket pointers of rows in this sorted order: the place of the first row with equal ids."""
    new = np.zeros(len(order), bool)
    new[:1] = True
    for x in ids:
        s = x[order]
        new[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return out


def window_buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every window of ``LENGTH`` bytes of the texts, with its text's number and start there.

    A bucket pointer is the place of a bucket in sorted order. The buckets of q-grams are
    refined by the pointers at the next offset, and so on with the pointers that this has
    renewed, until they span a window. A suffix that is alone in its bucket keeps its pointer
    and is sorted no more; it only serves others. Pointers never span more than a
    window, as windows that differ behind their end are still equal.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), sizes)
    start = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    left = np.repeat(sizes, sizes) - start  # bytes from here to the end of the text
    sums = prefix_sums(data)
    pointer = np.full(len(data), -1, np.int64)
    at = np.flatnonzero(left >= GRAM)
    gram = span_hash(sums, at, at + GRAM)
    pointer[at] = _pointers(np.argsort(gram, kind="stable"), gram)
    step = GRAM
    while step < LENGTH:
        at = np.flatnonzero(left >= 2 * step)
        shared = at[np.bincount(pointer[at], minlength=1)[pointer[at]] > 1]
        finer = np.full(len(data), -1, np.int64)
        finer[at] = pointer[at]
        bucket, later = pointer[shared], pointer[shared + step]
        order = np.lexsort((later, bucket))
        # A bucket's part gets the bucket's place and its own within the bucket.
        finer[shared] = bucket + _pointers(order, bucket, later) - _pointers(order, bucket)
        pointer, step = finer, 2 * step
    at = np.flatnonzero(pointer >= 0)
    return pointer[at], owner[at], start[at]


def _runs(owner: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Bounds of runs of windows that follow each other in one text."""
    new = np.ones(len(start) + 1, bool)
    new[1:-1] = (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)
    return np.flatnonzero(new)


def _refine(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated spans of surroundings that are alone, from the windows they share with others of their bucket."""
    for table in whole_groups(batches, ["gram"]):
        bounds = group_bounds(table.column("gram").to_numpy())
        for first, last in chunks(np.diff(bounds), PART):
            part = table.slice(bounds[first], bounds[last] - bounds[first])
            group = np.repeat(np.arange(last - first), np.diff(bounds[first : last + 1]))
            yield from _repeated(part, group)


def _repeated(part: pa.Table, group: np.ndarray) -> Iterator[pa.RecordBatch]:
    doc, lo, left, settled = (part.column(c).to_numpy() for c in ("doc", "lo", "left", "settled"))
    bucket, owner, start = window_buckets(part.column("around").to_pylist())
    bucket = _named(bucket, group[owner], left[owner] - start)
    repeated = (np.bincount(bucket)[bucket] > 1) & ~settled[owner]
    owner, start = owner[repeated], start[repeated]
    if len(owner):
        runs = _runs(owner, start)
        first, last = runs[:-1], runs[1:] - 1
        begin = lo[owner[first]] + start[first]
        end = lo[owner[last]] + start[last] + LENGTH
        columns = [pa.array(doc[owner[first]]), pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc", "lo", "hi"])


def _windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of the surroundings of large buckets as a row."""
    for batch in batches:
        for row in range(0, batch.num_rows, 500):
            part = batch.slice(row, 500)
            for gram, settled, doc, lo, left, text in zip(*(part.column(c).to_pylist() for c in ("gram", "settled", "doc", "lo", "left", "around")), strict=True):
                start = np.arange(len(text) - LENGTH + 1)
                window = span_hash(prefix_sums(np.frombuffer(text, np.uint8)), start, start + LENGTH)
                n = len(start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, gram)), pa.array((left - start).astype(np.int32)), pa.array(window.view(np.int64)), pa.array(np.full(n, doc)), pa.array((lo + start).astype(np.int32)), pa.array(np.full(n, settled))],
                    names=["gram", "offset", "window", "doc", "lo", "settled"],
                )


def _remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of every text, and its removed runs."""
    opener = zstandard.ZstdDecompressor()
    for batch in batches:
        for row in range(0, batch.num_rows, 200):
            part = batch.slice(row, 200)
            out: list[tuple] = []
            for doc, packed, marks, more in zip(*(part.column(c).to_pylist() for c in ("doc", "packed", "marks", "spans")), strict=True):
                spans = sorted([(m["lo"], m["hi"]) for m in marks if m["settled"]] + [(s["lo"], s["hi"]) for s in more or ()])
                merged: list[list[int]] = []
                for lo, hi in spans:
                    if merged and lo <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], hi)
                    else:
                        merged.append([lo, hi])
                if not merged:
                    continue
                text, at, rest = opener.decompress(packed), 0, hashlib.sha256()
                for lo, hi in merged:
                    rest.update(text[at:lo])
                    at = hi
                rest.update(text[at:])
                out.append((doc, sum(hi - lo for lo, hi in merged), len(merged), rest.hexdigest(), [{"lo": lo, "hi": hi} for lo, hi in merged]))
            if out:
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["doc", "removed", "n", "kept_sha256", "spans"])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``spans`` (lo, hi) of every row.

    A byte is removed if a string of 200 bytes that covers it starts anywhere else
    in the texts too, in the same text included; all are judged on the input. Spans
    are the maximal removed runs in bytes.

    A null text is empty. Texts below 200 bytes lose nothing. Repeated rows are
    documents of their own and lose all that is 200 bytes or longer; null ids stay.
    Other columns are ignored; an empty table gives an empty result.
    """
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Rows with equal id and text get equal results, so they may share an identifier.
    docs = docs.withColumn("doc", F.xxhash64("doc_id", "text"))
    found = kept(docs.select("doc", "text").mapInArrow(_anchor_rows, ANCHORS), "anchors")
    # Written first, so that both sides of the join are plain shuffles and a gram with very many rows can be split.
    shared = kept(found.groupBy("gram").agg(F.count("*").alias("rows")).where("rows > 1").select("gram"), "grams")
    repeated = kept(found.join(shared.hint("merge"), "gram"), "shared")

    span = [(F.col("at") - F.col("left")).cast("int").alias("lo"), (F.col("at") + F.col("right")).cast("int").alias("hi")]
    classes = kept(
        repeated.groupBy("gram", "around").agg(
            F.count("*").alias("rows"), F.min(F.struct("doc", "at", "left", "right")).alias("one")
        ),
        "classes",
    )
    open_buckets = kept(
        classes.groupBy("gram")
        .agg(F.count("*").alias("surroundings"), F.min("rows").alias("least"))
        .where("surroundings > 1 and least = 1")
        .select("gram", "surroundings"),
        "open",
    )
    asked = (
        classes.join(open_buckets, "gram")
        .select("gram", "surroundings", (F.col("rows") > 1).alias("settled"), "one.*")
        .select("doc", F.struct(*span, "gram", "at", "settled", "surroundings").alias("mark"))
    )
    settled = (
        repeated.join(classes.where("rows > 1").select("gram", "around"), ["gram", "around"])
        .select("doc", F.struct(*span, F.lit(None).cast("long").alias("gram"), "at", F.lit(True).alias("settled"), F.lit(None).cast("long").alias("surroundings")).alias("mark"))
    )
    marks = settled.union(asked).groupBy("doc").agg(F.collect_set("mark").alias("marks"))
    packed = docs.select("doc", "text").mapInArrow(_pack, "doc long, packed binary")
    # Repeated rows become one in each task before they are moved.
    touched = kept(packed.dropDuplicates(["doc"]).join(marks, "doc"), "touched")

    around = touched.where(F.exists("marks", lambda m: m["gram"].isNotNull())).mapInArrow(_cut_out, CUT_OUT)
    around = kept(around, "surroundings")
    common = around.where(F.col("surroundings") <= LARGE).repartition("gram").sortWithinPartitions("gram")
    spans = common.select("gram", "settled", "doc", "lo", "left", "around").mapInArrow(_refine, "doc long, lo int, hi int")
    windows = around.where(F.col("surroundings") > LARGE).mapInArrow(
        _windows, "gram long, offset int, window long, doc long, lo int, settled boolean"
    )
    twice = windows.groupBy("gram", "offset", "window").agg(F.count("*").alias("rows")).where("rows > 1").drop("rows")
    single = windows.where("not settled").join(twice, ["gram", "offset", "window"])
    spans = spans.union(single.select("doc", "lo", (F.col("lo") + LENGTH).cast("int").alias("hi")))
    spans = spans.groupBy("doc").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    cut = touched.join(spans, "doc", "left").select("doc", "packed", "marks", "spans")
    cut = cut.mapInArrow(_remove, "doc long, removed long, n long, kept_sha256 string, spans array<struct<lo: int, hi: int>>")

    whole = docs.select("doc_id", "doc", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    return whole.join(cut, "doc", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
        F.coalesce("spans", F.array().cast("array<struct<lo: int, hi: int>>")).alias("spans"),
    )
