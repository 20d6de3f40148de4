"""Mixing sources to target weights by balanced sampling with the cube method.

A document of a source is to be taken ``r`` times on average, ``r`` being the target of
the source over its size: the whole part of ``r`` for certain, and once more with its
fraction as probability. The flight of the cube method moves these probabilities in the
null-space of the balancing constraints (the tokens and the documents of a source) until
they are 0 or 1. It runs in blocks of documents; what a block leaves open, two documents
at most, goes on into the blocks of the next level, until one block holds the rest of a
source. There the landing drops the constraint on documents; the one document that is then
left open is taken in part, or by chance.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomframe.llm.common import SPACE, chunks, kept, sliced, utf8, whole_groups

#: Documents in a block of the flight.
BLOCK = 1000
NEAR = 1e-9


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        texts = utf8(batch.column("text"))
        counts = []
        for lo, hi in chunks(np.fromiter(map(len, texts), np.int64, len(texts)), 4 << 20):
            joined = b" " + b" ".join(texts[lo:hi]) + b" "
            space = SPACE[np.frombuffer(joined, np.uint8)]
            begins = np.concatenate(([0], np.cumsum(space[:-1] & ~space[1:])))
            ends = np.cumsum([len(t) + 1 for t in texts[lo:hi]])
            counts.append(np.diff(begins[ends], prepend=0))
        sizes = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("source"), pa.array(sizes, pa.int64()), batch.column("content")],
            names=["doc_id", "source", "size", "content"],
        )


def flight(sizes: list[float], chances: list[float], draws: Iterator[float]) -> list[float]:
    """Move chances within the null-space of both constraints, three open documents at a time, until two are open."""
    out = list(chances)
    active: list[int] = []
    for i in range(len(out)):
        if NEAR < out[i] < 1 - NEAR:
            active.append(i)
        if len(active) == 3:
            a, b, c = active
            # The direction that keeps both sums: the cross product of (1, 1, 1) and the sizes.
            u = (sizes[c] - sizes[b], sizes[a] - sizes[c], sizes[b] - sizes[a])
            scale = max(abs(x) for x in u)
            u = (1.0, -1.0, 0.0) if scale == 0 else tuple(x / scale for x in u)
            _step(out, active, u, next(draws))
            active = [i for i in active if NEAR < out[i] < 1 - NEAR]
    return out


def _step(out: list[float], active: list[int], u: tuple[float, ...], draw: float) -> None:
    """Walk along ``u`` or against it to the border of the cube; the chances of both keep all means."""
    up = min((1 - out[i]) / x if x > 0 else -out[i] / x for i, x in zip(active, u, strict=True) if x)
    down = min(out[i] / x if x > 0 else (out[i] - 1) / x for i, x in zip(active, u, strict=True) if x)
    step = up if draw * (up + down) < down else -down
    for i, x in zip(active, u, strict=True):
        moved = out[i] + step * x
        out[i] = 0.0 if moved < NEAR else 1.0 if moved > 1 - NEAR else moved


def landing(sizes: list[float], chances: list[float], draws: Iterator[float], part: bool) -> list[float]:
    """Decide the documents that a flight leaves open: first with tokens alone balanced, the last by chance.

    With ``part`` the last one keeps its fraction and is taken in part, which keeps the tokens of the source exact.
    """
    out = flight(sizes, chances, draws)
    active = [i for i in range(len(out)) if NEAR < out[i] < 1 - NEAR]
    if len(active) == 2:
        a, b = active
        big = max(sizes[a], sizes[b]) or 1.0
        u = (1.0, -1.0) if sizes[a] == sizes[b] else (sizes[b] / big, -sizes[a] / big)
        _step(out, active, u, next(draws))
        active = [i for i in active if NEAR < out[i] < 1 - NEAR]
    for i in active if not part else ():
        out[i] = 1.0 if next(draws) < out[i] else 0.0
    return out


def _fly(last: bool, part: bool):
    def fly(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["place", "block"], 20_000):
            place, block = table.column("place").to_numpy(), table.column("block").to_numpy()
            sizes = table.column("size").to_numpy().astype(float).tolist()
            chances = table.column("chance").to_numpy().tolist()
            new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (block[1:] != block[:-1]), [True])))
            moved: list[float] = []
            for lo, hi in zip(new[:-1].tolist(), new[1:].tolist(), strict=True):
                rng = np.random.default_rng([int(place[lo]), int(block[lo]), hi - lo])
                draws = iter(rng.random(hi - lo + 8).tolist())
                if last:
                    moved += landing(sizes[lo:hi], chances[lo:hi], draws, part)
                else:
                    moved += flight(sizes[lo:hi], chances[lo:hi], draws)
            table = table.set_column(table.column_names.index("chance"), "chance", pa.array(moved, pa.float64()))
            yield from table.to_batches()

    return fly


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``place`` and ``target`` of sources with ``source_size`` and ``rows``, one row for each.

    Sources stand by code point, null last, and weigh ``weights`` in turn. Together
    they get ``share`` of all sizes; a target stops at ``most`` times its source's
    size, and what that leaves is shared by weight among the others. The level at
    which nothing is above its limit follows from running sums over the sources in
    the order in which they reach their limits.
    """
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    place = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), F.pmod(F.col("place"), F.lit(len(weights))) + 1)
    ranked = sizes.withColumn("place", place).withColumn("weight", weight).withColumn("limit", most * F.col("source_size"))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = share * F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = F.col("left") / F.col("open_weight")
    return (
        ranked.withColumn("left", left)
        .withColumn("open_weight", open_weight)
        .withColumn("level", F.when(level * F.col("weight") <= F.col("limit"), level))
        .withColumn("level", F.max("level").over(every))
        .select(
            "source",
            "place",
            "source_size",
            "rows",
            F.least("limit", F.coalesce(F.col("level") * F.col("weight"), "limit")).alias("target"),
        )
    )


def mix(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, part: bool = True
) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` of every row of ``docs`` (doc_id, text, source).

    ``content`` identifies a row by a hash of these three columns.

    ``size`` counts words, ``taken`` the words taken: ``copies`` times ``size``, and
    for at most one document of a source a part of a further copy, so that the
    source meets its target to a word. Without ``part`` that document is taken
    or left by chance, and the source comes within its size of the target. The
    result depends on the rows only, not on how they are spread.

    A null text has size 0 and is taken without effect; a null source is a source
    of its own; repeated rows are documents of their own. With no words at all
    every target is 0. Other columns are ignored.
    """
    text = F.col("text").cast("string")
    counted = docs.select("doc_id", F.col("source").cast("string").alias("source"), text.alias("text"), F.xxhash64("doc_id", "source", text).alias("content"))
    kinds = {f.name: f.dataType.simpleString() for f in counted.schema}
    counted = kept(counted.mapInArrow(_count_words, f"doc_id {kinds['doc_id']}, source string, size long, content long"), "sizes")
    sources = counted.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    goals = kept(targets(sources, weights, share, most), "targets").withColumnRenamed("source", "of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goals = goals.withColumn("rate", rate).withColumn("sure", F.floor(F.col("rate") + NEAR))
    units = counted.join(goals, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id",
        "size",
        "content",
        "place",
        "source_size",
        "target",
        "sure",
        F.greatest(F.lit(0.0), F.col("rate") - F.col("sure")).alias("chance"),
        F.ceil(F.col("rows") / BLOCK).cast("long").alias("blocks"),
    )
    names = units.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in units.schema) + ", block long"
    decided: DataFrame | None = None
    level = 0
    while True:
        last = units.where("blocks > 1").isEmpty()
        block = F.lit(0).cast("long") if last else F.pmod(F.xxhash64("content", F.lit(level)), F.col("blocks"))
        flown = (
            units.withColumn("block", block)
            .repartition("place", "block")
            .sortWithinPartitions("place", "block", F.desc("size"), "content", "doc_id")
            .mapInArrow(_fly(last, part), schema)
        )
        flown = kept(flown.select(*names), f"flight-{level}")
        open_now = F.col("chance").between(NEAR, 1 - NEAR)
        settled = flown if last else flown.where(~open_now)
        decided = settled if decided is None else decided.union(settled)
        if last:
            break
        units = flown.where(open_now).withColumn("blocks", F.ceil(F.col("blocks") * 2 / BLOCK).cast("long"))
        level += 1
    whole = F.when(F.col("chance") > 1 - NEAR, 1).otherwise(0)
    return decided.select(
        "doc_id",
        "content",
        "size",
        F.col("source_size").cast("long").alias("source_size"),
        "target",
        (F.col("sure") + whole).cast("long").alias("copies"),
        (F.col("sure") * F.col("size") + F.round(F.col("chance") * F.col("size"))).cast("long").alias("taken"),
    )


def take(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` as often as ``mix`` takes them whole: the mixed corpus, with the same columns.

    Repeated rows are drawn one by one and come out as often as all of them together are taken.
    """
    content = F.xxhash64("doc_id", F.col("source").cast("string"), F.col("text").cast("string"))
    copies = mix(docs, part=False, **how).groupBy("content").agg(F.sum("copies").cast("int").alias("copies"))
    whole = docs.select(content.alias("content"), F.struct(*docs.columns).alias("row"))
    # Repeated rows become one in each task before they are moved.
    rows = whole.dropDuplicates(["content"]).join(copies.where("copies > 0"), "content")
    return rows.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
