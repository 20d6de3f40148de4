"""Near-duplicate documents by an LSH forest over MinHash signatures.

Every tree orders the documents by its own sequence of MinHash values. Documents
that share the first values of a tree form a region; within it, those next to each
other in the sorted order have the longest common prefixes. Links are looked for in
two steps:

1. Neighbours in the sorted order of every tree. A region that is too large for one task
   is cut deeper, by as many further values as it takes, and then by document: nothing is
   lost by that, since step 2 looks at whole regions.
2. All pairs of a region that the first step has not put in one component. Regions that
   are one component by then, as large groups of copies are, are left out before any
   row is moved; what remains of a large region is compared block by block. Pairs
   are never written: rows with a promising partner get their sets, and the task that
   compares them again returns links between components only.

Signatures only decide what is compared (two documents at the threshold stay apart
with a probability below ``MISS``); every link is confirmed on full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import exp, log

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomframe.llm.common import chunks, group_bounds, kept, mixed, pack_texts, sliced, utf8, whole_groups
from loomframe.llm.components import components
from loomframe.llm.shingles import minhash_seeds, minhashes, shingle_set
from loomframe.operators.joins import split_join

TREES = 20
DEPTH = 8
#: Accepted probability that a pair at the threshold is not compared.
MISS = 1e-6
#: Rows of a region that one task compares with each other.
BLOCK = 2048

CELL = ["tree", "key", "cell"]
SIGNED = "doc_id long, content long, n_shingles long, h1 long, h2 long, keys array<long>, orders array<binary>, sig binary"


def least_depth(percent: int, trees: int = TREES) -> int:
    """Values that a region shares: as many as keep the chance to miss a pair at the threshold below ``MISS``."""
    return max([1, *(d for d in range(1, DEPTH) if (1 - (percent / 100) ** d) ** trees <= MISS)])


def least_matches(percent: int, n: int = TREES * DEPTH) -> int:
    """Equal signature values below which a pair is at the threshold with a probability under ``MISS`` only."""
    t = percent / 100

    def tail(c: int) -> float:
        q = max(c / n, 1e-9)
        return exp(-n * (q * log(q / t) + (1 - q) * log((1 - q) / (1 - t))))

    return next(c for c in range(int(n * t), -1, -1) if c == 0 or tail(c) <= MISS)


def _signer(size: int, depth: int):
    seeds = minhash_seeds(TREES * DEPTH)

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = utf8(batch.column("text"))
            for lo, hi in chunks(np.fromiter(map(len, texts), np.int64, len(texts)), 2 << 20):
                sets = [shingle_set(t, size) for t in texts[lo:hi]]
                full = [i for i, s in enumerate(sets) if len(s)]
                n = hi - lo
                keys: list = [None] * n
                orders: list = [None] * n
                sigs: list = [None] * n
                ids = np.zeros((n, 2), np.uint64)
                if full:
                    values = minhashes([sets[i] for i in full], seeds).reshape(len(full), TREES, DEPTH)
                    key = np.zeros((len(full), TREES), np.uint64)
                    for d in range(depth):
                        key = mixed(key * np.uint64(31) + values[:, :, d] + np.uint64(1))
                    key = key.view(np.int64)
                    rest = np.ascontiguousarray(values[:, :, depth:].astype(">u4"))
                    low = np.ascontiguousarray((values & np.uint32(255)).astype(np.uint8)).reshape(len(full), -1)
                    for at, i in enumerate(full):
                        keys[i] = key[at]
                        orders[i] = [r.tobytes() for r in rest[at]]
                        sigs[i] = low[at].tobytes()
                        ids[i] = mixed(sets[i]).sum(dtype=np.uint64), mixed(sets[i] ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(lo, n).cast(pa.int64()),
                        batch.column("content").slice(lo, n),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(ids[:, 0].view(np.int64)),
                        pa.array(ids[:, 1].view(np.int64)),
                        pa.array(keys, pa.list_(pa.int64())),
                        pa.array(orders, pa.list_(pa.binary())),
                        pa.array(sigs, pa.binary()),
                    ],
                    names=["doc_id", "content", "n_shingles", "h1", "h2", "keys", "orders", "sig"],
                )

    return sign


def _matrix(column: pa.Array) -> np.ndarray:
    """Signatures of equal length as rows."""
    flat = b"".join(column.to_pylist())
    return np.frombuffer(flat, np.uint8).reshape(len(column), -1)


def _near(least: int):
    """Keeps the pairs of neighbours whose signatures agree in ``least`` values."""

    def near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                same = (_matrix(batch.column("sig")) == _matrix(batch.column("sig_b"))).sum(axis=1)
                yield batch.select(["a", "b"]).filter(pa.array(same >= least))

    return near


def _candidates(table: pa.Table, least: int, percent: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """Bounds of each cell, and for each of its rows the later rows that are worth a comparison.

    These are of another component and of a fitting size, share no region of an earlier tree with it (they are
    compared there) and agree in ``least`` signature values.
    """
    sizes, component, block, two, tree = (
        table.column(c).to_numpy() for c in ("n_shingles", "component", "block", "two", "tree")
    )
    sig = _matrix(table.column("sig").combine_chunks())
    keys = table.column("keys").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
    bounds = group_bounds(*(table.column(c).to_numpy() for c in CELL))
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        earlier = int(tree[lo])
        for i in range(lo, hi - 1):
            rest = slice(i + 1, hi)
            fits = component[rest] != component[i]
            fits &= 100 * np.minimum(sizes[rest], sizes[i]) >= percent * np.maximum(sizes[rest], sizes[i])
            if two[i]:
                fits &= block[rest] != block[i]
            at = np.flatnonzero(fits) + i + 1
            if len(at):
                at = at[~(keys[at, :earlier] == keys[i, :earlier]).any(axis=1)]
                at = at[(sig[at] == sig[i]).sum(axis=1) >= least]
                if len(at):
                    yield lo, hi, i, at


def _across(least: int, percent: int):
    """The rows of each cell that have a partner worth a comparison."""

    def across(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, CELL):
            marked = np.zeros(table.num_rows, bool)
            for _, _, i, at in _candidates(table, least, percent):
                marked[i] = True
                marked[at] = True
            yield from table.filter(pa.array(marked)).to_batches()

    return across


def _confirm_cells(least: int, percent: int):
    """Links of each cell by full sets: of those that lead from a row into one and the same component, one."""

    def confirm(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, CELL):
            ids = table.column("doc_id").to_numpy()
            sets = [np.frombuffer(w, np.uint64) for w in table.column("words").to_pylist()]
            found: list[tuple[int, int]] = []
            cell, start, known, flags, root = -1, 0, sets[0], sets[0], ids
            bounds = np.zeros(1, np.int64)
            for lo, hi, i, at in _candidates(table, least, percent):
                if cell != lo:
                    cell, start = lo, lo
                    bounds = np.concatenate(([0], np.cumsum([len(s) for s in sets[lo:hi]])))
                    distinct, known = np.unique(np.concatenate(sets[lo:hi]), return_inverse=True)
                    flags = np.zeros(len(distinct), np.int64)
                    root = table.column("component").to_numpy()[lo:hi].copy()
                at, i = at - start, i - start
                own = known[bounds[i] : bounds[i + 1]]
                flags[own] = 1
                at = at[root[at] != root[i]]
                if len(at):
                    first = int(at[0])
                    inside = flags[known[bounds[first] : bounds[int(at[-1]) + 1]]]
                    shared = np.add.reduceat(inside, bounds[first : int(at[-1]) + 1] - bounds[first])[at - first]
                    total = len(own) + np.diff(bounds)[at] - shared
                    for j in at[100 * shared >= percent * total].tolist():
                        if root[j] != root[i]:
                            found.append((ids[start + i], ids[start + j]))
                            root[root == root[j]] = root[i]
                flags[own] = 0
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return confirm


def _set_maker(size: int):
    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingle_set(opener.decompress(t), size).tobytes() for t in part.column("packed").to_pylist()]
                columns = [part.column("doc_id"), pa.array(sets, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "words"])

    return make


def _confirm(percent: int):
    """Keeps the pairs whose full sets have ``100 * intersection >= percent * union``."""

    def confirm(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("words_a").to_pylist(), batch.column("words_b").to_pylist(), strict=True):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return confirm


def _cut(tree: Column, rows: Column, order: Column, doc: Column, depth: int) -> Column:
    """What splits the sorted order of a region that is too large: one further value, two ..., then the document."""
    deeper = F.lit("")
    for d in range(1, DEPTH - depth + 1):
        deeper = F.when(rows > BLOCK * 4 ** (d - 1), F.hex(F.substring(order, 1, 4 * d))).otherwise(deeper)
    far = rows > BLOCK * 4 ** (DEPTH - depth)
    salt = F.when(far, F.pmod(F.xxhash64(doc, tree), F.ceil(rows / BLOCK))).otherwise(0)
    return F.xxhash64(deeper, salt)


def _read(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and ``content``: id and hash of the text tell rows apart, also where texts share an id."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("content"))


def _grouped(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The signed rows of ``docs``, and all classes of equal sets with the row that stands for each and their component.

    Classes are numbered when they are written; ``component`` is the number of one of them.
    """
    depth, least = least_depth(percent), least_matches(percent)
    signed = kept(docs.mapInArrow(_signer(size, depth), SIGNED), "signed")
    usable = signed.where("doc_id is not null and n_shingles > 0")
    classes = usable.groupBy("h1", "h2", "n_shingles").agg(F.min(F.struct("doc_id", "content")).alias("head"))
    classes = classes.select("h1", "h2", "n_shingles", "head.doc_id", "head.content", F.monotonically_increasing_id().alias("class"))
    classes = kept(classes, "classes")
    # One row of every class goes through the search, under the number of the class. Only keys are moved to find
    # shared regions. What these joins look for grows with the corpus, so none of it is broadcast.
    row = ["doc_id", "content"]
    heads = classes.select(*row, "class")

    def of_heads(rows: DataFrame, heads: DataFrame, *columns: str) -> DataFrame:
        found = rows.join(heads.hint("merge"), row).dropDuplicates(["class"])
        return found.select(F.col("class").alias("doc_id"), *columns)

    keys = kept(of_heads(usable.select(*row, "keys"), heads, "keys"), "keys")
    places = keys.select("doc_id", F.posexplode("keys").alias("tree", "key"))
    # Written first, so that both sides of the join are plain shuffles and a region with very many rows can be split.
    counts = kept(places.groupBy("tree", "key").agg(F.count("*").alias("rows")).where("rows > 1"), "counts")
    regions = kept(places.join(counts.hint("merge"), ["tree", "key"]), "regions")
    sharing = regions.select(F.col("doc_id").alias("class")).distinct()
    sharing = kept(heads.join(sharing.hint("merge"), "class"), "sharing")
    signs = usable.select(*row, "n_shingles", "sig", "keys", "orders")
    signs = kept(of_heads(signs, sharing, "n_shingles", "sig", "keys", "orders"), "signs")
    texts = docs.mapInArrow(pack_texts(*row), "doc_id long, content long, packed binary")
    texts = of_heads(texts, sharing, "packed")
    sets = kept(texts.mapInArrow(_set_maker(size), "doc_id long, words binary"), "sets")

    chained = regions.join(signs.hint("merge"), "doc_id")
    chained = chained.withColumn("order", F.col("orders")[F.col("tree")])
    cut = _cut(F.col("tree"), F.col("rows"), F.col("order"), F.col("doc_id"), depth)
    order = Window.partitionBy("tree", "key", "cut").orderBy("order", "doc_id")
    neighbours = (
        chained.withColumn("cut", cut)
        .select(
            F.col("doc_id").alias("x"),
            F.lead("doc_id").over(order).alias("y"),
            "n_shingles",
            F.lead("n_shingles").over(order).alias("n_b"),
            "sig",
            F.lead("sig").over(order).alias("sig_b"),
        )
        .where(
            F.col("y").isNotNull()
            & (100 * F.least("n_shingles", "n_b") >= percent * F.greatest("n_shingles", "n_b"))
        )
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "sig", "sig_b")
        .mapInArrow(_near(least), "a long, b long")
    )
    pairs = kept(neighbours.distinct(), "pairs")
    for side in ("a", "b"):
        words = sets.select(F.col("doc_id").alias(side), F.col("words").alias(f"words_{side}"))
        pairs = pairs.join(words.hint("merge"), side)
    links = pairs.select("a", "b", "words_a", "words_b").mapInArrow(_confirm(percent), "a long, b long")
    first = components(links)

    labelled = regions.join(first.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    labelled = kept(labelled.withColumn("component", F.coalesce("component", "doc_id")), "labelled")
    apart = (
        labelled.groupBy("tree", "key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("rows"))
        .where("low < high")
        .select("tree", "key", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))
    )
    apart = kept(apart, "apart")
    block = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("blocks")).cast("int")
    cells = (
        labelled.join(apart, ["tree", "key"])
        .join(signs.hint("merge"), "doc_id")
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("two", F.col("other") != F.col("block"))
        .withColumn("cell", F.least("block", "other") * F.col("blocks") + F.greatest("block", "other"))
        .select("tree", "key", "cell", "block", "two", "doc_id", "n_shingles", "component", "sig", "keys")
    )
    promising = cells.repartition(*CELL).sortWithinPartitions(*CELL).mapInArrow(_across(least, percent), cells.schema)
    promising = kept(promising, "cells")
    links = (
        promising.join(sets.hint("merge"), "doc_id")
        .repartition(*CELL)
        .sortWithinPartitions(*CELL)
        .mapInArrow(_confirm_cells(least, percent), "a long, b long")
    )
    for side in ("a", "b"):
        label = first.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}"))
        links = links.join(label, side, "left").withColumn(side, F.coalesce(f"c_{side}", side)).drop(f"c_{side}")
    second = components(links).select(F.col("node").alias("component"), F.col("component").alias("final"))

    found = (
        first.join(second, "component", "left")
        .select("node", F.coalesce("final", "component").alias("component"))
        .union(
            second.join(first.select(F.col("node").alias("component")), "component", "left_anti").select(
                "component", "final"
            )
        )
    )
    labels = found.select(F.col("node").alias("class"), "component")
    labelled = classes.join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))
    return signed, kept(labelled, "labelled")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for every row of ``docs`` (doc_id, text).

    Two documents are linked if ``100 * intersection >= percent * union`` holds for
    their sets of ``size``-word shingles; ``component_id`` is the smallest doc_id
    that links lead to, ``kept`` marks the document that carries it. Documents with
    equal sets form a class of which one goes through the search. Rows of one id with
    different texts are one document that has the links of all its texts.

    Null and empty texts and texts of white space have no shingles and are linked
    with nothing. Repeated rows get the same result. A null doc_id takes part in
    nothing and is its own component, null, and kept. An empty table gives an
    empty result; other columns are ignored.
    """
    signed, classes = _grouped(_read(docs), size, percent)
    same = ["h1", "h2", "n_shingles"]
    # Ids that stand on several texts, which are few or none, tie the components of these together.
    usable = signed.where("doc_id is not null and n_shingles > 0").select("doc_id", *same)
    several = usable.groupBy("doc_id").agg(F.min(F.struct(*same)).alias("low"), F.max(F.struct(*same)).alias("high")).where("low <> high")
    ties = split_join(usable, several.select("doc_id"), "doc_id", "left_semi").distinct().join(classes.select(*same, "component"), same)
    ties = kept(ties.select("doc_id", "component"), "ties")
    first = ties.groupBy("doc_id").agg(F.min("component").alias("a"))
    tied = components(split_join(ties, first, "doc_id").select("a", F.col("component").alias("b")))
    whole = classes.join(tied.select(F.col("node").alias("component"), F.col("component").alias("whole")), "component", "left")
    whole = kept(whole.withColumn("whole", F.coalesce("whole", "component")), "whole")
    smallest = whole.groupBy("whole").agg(F.min("doc_id").alias("component_id"))
    # Written, so that neither a large component nor a large class makes one task of its rows.
    by_class = kept(split_join(whole, smallest, "whole").select(*same, "component_id"), "by-class")
    result = signed.select("doc_id", *same).join(by_class, same, "left")
    own = F.when(F.col("doc_id").isNull() | (F.col("n_shingles") == 0), F.col("doc_id")).otherwise(F.col("component_id"))
    return result.select("doc_id", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def representatives(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` with one text of every group of near duplicates: that of the smallest id.

    Here a text is a document, also where several share an id, so unrelated texts of one
    id all stay. Repeated rows become one; texts without shingles stay, once for each id;
    rows without an id all stay. The columns are those of ``docs``.
    """
    signed, classes = _grouped(_read(docs), size, percent)
    row = ["doc_id", "content"]
    chosen = classes.groupBy("component").agg(F.min(F.struct(*row)).alias("head")).select("head.*")
    empty = signed.where("doc_id is not null and n_shingles = 0").select(*row).distinct()
    chosen = kept(chosen.union(empty), "chosen").select(F.col("doc_id").alias("_id"), F.col("content").alias("_content"))
    named = docs.where("doc_id is not null")
    named = named.withColumns({"_id": F.col("doc_id").cast("long"), "_content": F.xxhash64(F.col("text").cast("string"))})
    # Copies of a row become one in each task before they are moved.
    once = named.dropDuplicates(["_id", "_content"])
    return once.join(chosen.hint("merge"), ["_id", "_content"], "left_semi").select(*docs.columns).union(docs.where("doc_id is null"))
