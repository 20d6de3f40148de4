"""Approximate nearest neighbours by a forest of random-projection trees.

Every tree halves a sample of the vectors by a random direction, again and again, down
to leaves that hold about ``LEAF`` of all vectors. All vectors are put into the leaf they
fall in, in every tree. A query walks all trees at once with one priority queue: the
branch whose nearest border it is furthest inside of, or least beyond, comes next, until
enough leaves are reached. The vectors of these leaves are ranked by exact distances.

Vectors stand once in a block of neighbouring leaves of the first tree, with their leaves in
all trees. A query goes to the blocks where some vector is in one of its leaves, without a
list of them: a block finds the leaves of a query again from the margin that its walk ended at.

How many leaves are enough depends on the data: few where vectors form clusters, a large
part of all where they have no structure that a neighbour search could use. So the number
is taken from the sample, as the one at which members of it find the wanted share of
their true neighbours there.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.llm.cells import FOUND, best, distinct_rows, finite, first_k, matrix
from loomframe.llm.common import group_bounds, kept, mixed

TREES = 4
LEAF = 1024
#: Share of the true neighbours to be found, and members of the sample that it is measured on.
RECALL = 0.96
PROBES = 100
#: Vectors that the trees are fitted on, at most; all vectors are indexed.
SAMPLE = 20_000
#: Groups of neighbouring leaves in a tree, at most; blocks and the ways to them are made of these.
GROUPS = 64
#: Bytes of the vectors of a block at most, about, vectors that make one block, and blocks that any number of queries is sent to.
BLOCK_BYTES = 1 << 27
BLOCK = 8192
BLOCKS = 24
#: Numbers of a table of queries by leaves, vectors of a step, and pairs whose exact distances are taken at once.
TABLE = 1 << 22
STEP = 1024
PAIRS = 1 << 16


@dataclass
class Tree:
    """Inner nodes by number: direction, border and both children; a child below 0 is the leaf ``-1 - child``."""

    directions: np.ndarray
    borders: np.ndarray
    children: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every row."""
        node = np.zeros(len(x), np.int64) if len(self.borders) else np.full(len(x), -1)
        while (inner := np.flatnonzero(node >= 0)).size:
            at = node[inner]
            side = np.einsum("ij,ij->i", x[inner], self.directions[at]) > self.borders[at]
            node[inner] = self.children[at, side.astype(np.int64)]
        return -1 - node


def grow(sample: np.ndarray, leaf: int, rng: np.random.Generator) -> Tree:
    """Split the sample at the median of its projections on the line through two of its members."""
    directions, borders, children = [], [], []
    n_leaves = 0
    todo = [(np.arange(len(sample)), -1, 0)]
    while todo:
        rows, parent, side = todo.pop()
        split = None
        if len(rows) > leaf:
            for _ in range(3):
                a, b = sample[rng.choice(rows, 2, replace=False)]
                direction = (a - b) + 1e-3 * rng.standard_normal(sample.shape[1])
                length = np.linalg.norm(direction)
                if length == 0:
                    continue
                projected = sample[rows] @ (direction / length)
                border = np.median(projected)
                right = projected > border
                if right.any() and not right.all():
                    split = direction / length, border, right
                    break
        if split is None:
            number = -1 - n_leaves
            n_leaves += 1
        else:
            number = len(borders)
            directions.append(split[0])
            borders.append(split[1])
            children.append([0, 0])
            todo += [(rows[~split[2]], number, 0), (rows[split[2]], number, 1)]
        if parent >= 0:
            children[parent][side] = number
    d = sample.shape[1]
    return Tree(np.array(directions).reshape(-1, d), np.array(borders), np.array(children, np.int64).reshape(-1, 2))


def walk(trees: list[Tree], x: np.ndarray, n_leaves: int) -> list[tuple[int, int]]:
    """The first leaves of all trees in the order of one shared priority queue, as (tree, leaf)."""
    queue = [(-np.inf, t, 0 if len(tree.borders) else -1) for t, tree in enumerate(trees)]
    heapq.heapify(queue)
    found = []
    while queue and len(found) < n_leaves:
        margin, t, node = heapq.heappop(queue)
        if node < 0:
            found.append((t, -1 - node))
            continue
        tree = trees[t]
        over = float(x @ tree.directions[node] - tree.borders[node])
        left, right = tree.children[node].tolist()
        near, far = (right, left) if over > 0 else (left, right)
        # Smaller comes first: how far the query is beyond the worst border on the way.
        heapq.heappush(queue, (max(margin, -abs(over)), t, near))
        heapq.heappush(queue, (max(margin, abs(over)), t, far))
    return found


def enough_leaves(forest: list[Tree], sample: np.ndarray, k: int, recall: float, rng: np.random.Generator) -> int:
    """Leaves after which members of the sample have met the share ``recall`` of their ``k`` nearest in it."""
    placed = [tree.leaves(sample) for tree in forest]
    total = sum(int(leaf.max()) + 1 for leaf in placed)
    met = []
    for i in rng.choice(len(sample), min(PROBES, len(sample)), replace=False).tolist():
        distance = ((sample - sample[i]) ** 2).sum(axis=1)
        distance[i] = np.inf
        near = np.argsort(distance, kind="stable")[: min(k, len(sample) - 1)]
        turn = {place: n for n, place in enumerate(walk(forest, sample[i], total), 1)}
        met += [min(turn[t, int(leaf[j])] for t, leaf in enumerate(placed)) for j in near.tolist()]
    return int(np.quantile(met, recall, method="higher")) if met else total


def margins(tree: Tree, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What ``walk`` orders by, for all queries: of every inner node, and of every leaf."""
    over = tree.directions @ x.T - tree.borders[:, None]
    inner, leaf = (np.full((len(over) + n, len(x)), -np.inf) for n in (0, 1))
    level = np.arange(min(1, len(over)))
    while level.size:
        for child, beyond in ((tree.children[level, 0], over[level]), (tree.children[level, 1], -over[level])):
            worst = np.maximum(inner[level], beyond)
            inner[child[child >= 0]] = worst[child >= 0]
            leaf[-1 - child[child < 0]] = worst[child < 0]
        level = tree.children[level].ravel()
        level = level[level >= 0]
    return inner, leaf


def first_leaves(trees: list[Tree], x: np.ndarray, n_leaves: int) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
    """The leaves of ``walk`` for all queries, as a table of leaves by queries, trees one after another.

    Also the margin below which all leaves are among them, and those beyond it by number: of leaves
    that share the margin of the last one, ``walk`` takes some.
    """
    both = [margins(tree, x) for tree in trees]
    leaf = np.concatenate([m for _, m in both])
    n_leaves = min(n_leaves, len(leaf))
    last = np.partition(leaf, n_leaves - 1, axis=0)[n_leaves - 1]
    widest = max((np.abs(tree.borders).max(initial=0) for tree in trees), default=0)
    # Rounding errors stay far below the difference.
    sure = last - 1e-12 * (np.sqrt((x**2).sum(axis=1)) + widest)
    reached = leaf < sure
    queues: list[list[tuple[float, int, int]]] = [[] for _ in x]
    for t, (tree, (inner, own)) in enumerate(zip(trees, both, strict=True)):
        # A walk still has to open what is as far as its last leaf but hangs from what is nearer.
        for margin, number, inside in ((inner, lambda i: i, True), (own, lambda i: -1 - i, False)):
            parent = np.full(len(margin), -1)
            for side in (0, 1):
                child = tree.children[:, side]
                of = np.flatnonzero((child >= 0) == inside)
                parent[number(child[of])] = of
            above = np.concatenate([inner, np.full((1, len(x)), -np.inf)])[parent]
            places, asked = np.nonzero((margin >= sure) & (margin <= last) & ((above < sure) | (parent < 0)[:, None]))
            for i, q in zip(places.tolist(), asked.tolist(), strict=True):
                queues[q].append((float(margin[i, q]), t, number(i)))
    first = np.cumsum([0] + [len(m) for _, m in both])
    ties: list[list[int]] = []
    for q, (queue, n) in enumerate(zip(queues, (n_leaves - reached.sum(axis=0)).tolist(), strict=True)):
        heapq.heapify(queue)
        ties.append([])
        while len(ties[-1]) < n:
            _, t, node = heapq.heappop(queue)
            if node < 0:
                ties[-1].append(int(first[t]) - 1 - node)
                continue
            for child in trees[t].children[node].tolist():
                margin = both[t][0][child, q] if child >= 0 else both[t][1][-1 - child, q]
                heapq.heappush(queue, (float(margin), t, child))
        reached[ties[-1], q] = True
    return reached, sure, ties


def again(trees: list[Tree], x: np.ndarray, sure: np.ndarray, ties: list[list[int]]) -> np.ndarray:
    """The table of ``first_leaves`` from what it returned beside it."""
    reached = np.concatenate([margins(tree, x)[1] for tree in trees]) < sure
    for q, own in enumerate(ties):
        reached[own, q] = True
    return reached


@dataclass
class Blocks:
    """Where vectors and queries go: groups of leaves, first block and number of blocks of each group of the first tree."""

    shift: list[int]
    first: np.ndarray
    pieces: np.ndarray
    #: Above 0 where a vector of the block is in the group, for groups of all trees, one tree after another.
    meets: np.ndarray


def _shifts(trees: list[Tree]) -> list[int]:
    """Bits that make a group of the number of a leaf."""
    return [max(0, (len(tree.borders) // GROUPS).bit_length()) for tree in trees]


def _n_groups(trees: list[Tree]) -> list[int]:
    return [(len(tree.borders) >> shift) + 1 for tree, shift in zip(trees, _shifts(trees), strict=True)]


def _tile(trees: list[Tree]) -> int:
    """Queries that are held with all leaves at once."""
    return max(16, min(256, TABLE // sum(len(tree.borders) + 1 for tree in trees)))


def _trees(forest: Broadcast) -> list[Tree]:
    """The trees of a task; arrays travel, as executors need no copy of the package."""
    return [Tree(*arrays) for arrays in forest.value]


def _census(forest: Broadcast, dimensions: int):
    """How many vectors are in a group of the first tree and one of any tree, both by number."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = _trees(forest)
        sizes, shifts = _n_groups(trees), _shifts(trees)
        total = np.zeros((sizes[0], sum(sizes)), np.int64)
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("vector"), dimensions)
                groups = [tree.leaves(x) >> shift for tree, shift in zip(trees, shifts, strict=True)]
                for at, own in zip(np.cumsum([0, *sizes]).tolist(), groups, strict=False):
                    total += np.bincount(groups[0] * total.shape[1] + at + own, minlength=total.size).reshape(total.shape)
        a, b = np.nonzero(total)
        columns = [pa.array(c) for c in (a.astype(np.int32), b.astype(np.int32), total[a, b])]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "n"])

    return count


def blocks_of(trees: list[Tree], together: np.ndarray, size: int) -> Blocks:
    """Blocks of about ``size`` vectors from the census: neighbouring groups of the first tree, or pieces of a large one."""
    n = together[:, : len(together)].diagonal()
    pieces = np.maximum(1, -(-n // size))
    first = np.zeros(len(n), np.int64)
    block, held = -1, size
    for g, count in enumerate(n.tolist()):
        if held + count > size:
            block, held = block + 1, 0
        first[g] = block
        held += count
        block += int(pieces[g]) - 1
    meets = np.zeros((block + 1, together.shape[1]), np.float32)
    for g, (at, more) in enumerate(zip(first.tolist(), pieces.tolist(), strict=True)):
        meets[at : at + more] += together[g] > 0
    return Blocks(_shifts(trees), first, pieces, meets)


#: Columns of vectors and queries on their way: ``leaves`` are those of a vector, or of a query those beyond ``sure``.
SENT = ["block", "asks", "place", "vec_id", "row", "copies", "vector", "leaves", "sure"]


def _sent(block, asks: bool, place, batch: pa.RecordBatch, leaves: pa.Array, sure) -> pa.RecordBatch:
    columns = [pa.array(block.astype(np.int32)), pa.array(np.full(len(block), asks)), pa.array(place.astype(np.int32))]
    columns += [batch.column(c) for c in ("vec_id", "row", "copies", "vector")]
    return pa.RecordBatch.from_arrays([*columns, leaves, pa.array(sure, pa.float64())], names=SENT)


def _into_blocks(forest: Broadcast, dimensions: int, blocks: Blocks):
    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = _trees(forest)
        first = np.cumsum([0] + [len(tree.borders) + 1 for tree in trees])[:-1]
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("vector"), dimensions)
                leaves = np.stack([tree.leaves(x) for tree in trees], axis=1)
                group = leaves[:, 0] >> blocks.shift[0]
                # Equal vectors have one hash; with their ids they are dealt out over the pieces of a group.
                number = (batch.column("row").to_numpy() ^ batch.column("vec_id").to_numpy()).view(np.uint64)
                block = blocks.first[group] + (mixed(number) % blocks.pieces[group].astype(np.uint64)).astype(np.int64)
                ends = pa.array(np.arange(0, leaves.size + 1, len(trees), dtype=np.int32))
                lists = pa.ListArray.from_arrays(ends, pa.array((leaves + first).ravel().astype(np.int32)))
                yield _sent(block, False, leaves[:, 0], batch, lists, np.full(len(x), np.nan))

    return place


def _walks(forest: Broadcast, dimensions: int, n_leaves: int, blocks: Blocks):
    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = _trees(forest)
        sizes = [len(tree.borders) + 1 for tree in trees]
        starts = np.cumsum([0, *sizes]).tolist()
        groups = np.concatenate([np.arange(at, at + n, 1 << s) for at, n, s in zip(starts, sizes, blocks.shift, strict=False)])
        for batch in batches:
            for lo in range(0, batch.num_rows, _tile(trees)):
                some = batch.slice(lo, _tile(trees))
                x = matrix(some.column("vector"), dimensions)
                reached, sure, ties = first_leaves(trees, x, n_leaves)
                grouped = np.logical_or.reduceat(reached, groups, axis=0)
                q, block = np.nonzero((blocks.meets @ grouped.astype(np.float32)).T)
                own = trees[0].leaves(x)
                lists = pa.array(ties, pa.list_(pa.int32())).take(pa.array(q))
                yield _sent(block, True, own[q], some.take(pa.array(q)), lists, sure[q])

    return ask


@dataclass
class Rough:
    """Vectors less their mean in single precision, with the sum of their squares as one more component."""

    mean: np.ndarray
    extended: np.ndarray
    #: Largest sums of squares, less the mean and as given.
    widest: float
    longest: float


def rough(vectors: np.ndarray) -> Rough:
    with np.errstate(over="ignore", invalid="ignore"):
        out = Rough(vectors.mean(axis=0, dtype=np.float64), np.empty((len(vectors), vectors.shape[1] + 1), np.float32), 0.0, 0.0)
        for lo in range(0, len(vectors), 8 * STEP):
            given = vectors[lo : lo + 8 * STEP].astype(np.float64)
            part = given - out.mean
            squares = (part**2).sum(axis=1)
            out.extended[lo : lo + len(part), :-1] = part
            out.extended[lo : lo + len(part), -1] = squares
            out.widest = float(np.maximum(out.widest, squares.max()))
            out.longest = float(np.maximum(out.longest, (given**2).sum(axis=1).max()))
    # What is too large is no number, and looked at in any case.
    out.extended[np.isinf(out.extended[:, -1]), -1] = np.nan
    return out


def _nearest(k: int, reached: np.ndarray, query_ids, x, ids, vectors, about: Rough, leaves):
    """Places of queries and of the ``k`` nearest vectors that are in a leaf of the query, with exact distances."""
    rows = np.flatnonzero(reached.any(axis=1)[leaves].any(axis=1))
    met = np.ascontiguousarray(reached.T)
    with np.errstate(over="ignore", invalid="ignore"):
        turned = x - about.mean
        own = (turned**2).sum(axis=1)
        asked = np.concatenate([-2 * turned, np.ones((len(x), 1))], axis=1).astype(np.float32)
        # What rounding can do to the products, and to the differences from the mean.
        room = (own + about.widest) * (x.shape[1] + 16) * 2.0**-22 + 1e-20 * ((x**2).sum(axis=1) + about.longest)
    bar = np.full(len(x), np.inf)
    best_q, best_v, best_d = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    lo, step = 0, min(64, STEP)
    while lo < len(rows):
        at = rows[lo : lo + step]
        lo, step = lo + step, min(2 * step, STEP)
        with np.errstate(over="ignore", invalid="ignore"):
            most = (bar**2 * (1 + 1e-5) + room - own).astype(np.float32)
            # Squared distances less ``own``; what is no number is looked at.
            far = asked @ about.extended[at].T > most[:, None]
        q, v = np.divmod(np.flatnonzero(~far.ravel()), len(at))
        v = at[v]
        good = query_ids[q] != ids[v]
        good &= np.logical_or.reduce([met[q, leaves[v, t]] for t in range(leaves.shape[1])])
        q, v = q[good], v[good]
        for a in range(0, len(q), PAIRS):
            pq, pv = q[a : a + PAIRS], v[a : a + PAIRS]
            with np.errstate(over="ignore"):
                distance = np.sqrt(((vectors[pv] - x[pq]) ** 2).sum(axis=1))
            near = distance <= bar[pq]
            best_q, best_v, best_d = (np.concatenate(c) for c in ((best_q, pq[near]), (best_v, pv[near]), (best_d, distance[near])))
            first = first_k(best_q, ids[best_v], best_d, k)
            best_q, best_v, best_d = best_q[first], best_v[first], best_d[first]
            full = np.bincount(best_q, minlength=len(x)) == k
            worst = np.full(len(x), -np.inf)
            np.maximum.at(worst, best_q, best_d)
            bar[full] = worst[full]
    return best_q, best_v, best_d


def _search(forest: Broadcast, dimensions: int, k: int, kind: type):
    """From rows of ``SENT``, sorted by block with its vectors first: what its queries find in it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = _trees(forest)
        block, held, cell = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            number, asks = batch.column("block").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
            bounds = group_bounds(number, asks).tolist()
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                part = batch.slice(lo, hi - lo)
                if number[lo] != block:
                    block, held, cell = number[lo], [], None
                names = ["vec_id", "row", "copies"]
                if not asks[lo]:
                    leaves = part.column("leaves").flatten().to_numpy().reshape(-1, len(trees))
                    held.append((*(part.column(c).to_numpy() for c in names), leaves, matrix(part.column("vector"), dimensions, kind)))
                    continue
                if not held and cell is None:
                    continue
                if cell is None:
                    held, cell = [], [np.concatenate(c) for c in zip(*held, strict=True)]
                    about = rough(cell[-1])
                ids, row, copies, leaves, vectors = cell
                for at in range(0, part.num_rows, _tile(trees)):
                    some = part.slice(at, _tile(trees))
                    asked, asked_row, asked_copies = (some.column(c).to_numpy() for c in names)
                    x = matrix(some.column("vector"), dimensions)
                    reached = again(trees, x, some.column("sure").to_numpy(), some.column("leaves").to_pylist())
                    q, v, d = _nearest(k, reached, asked, x, ids, vectors, about, leaves)
                    columns = [asked[q], asked_row[q], ids[v], row[v], asked_copies[q] * copies[v], d]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=FOUND)

    return run


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 10, trees: int = TREES, recall: float = RECALL, seed: int = 3
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` nearest vectors found for each query.

    Both inputs have ``vec_id`` and ``vector`` (array of numbers). The score is the
    Euclidean distance of the original vectors in double precision; a query never
    finds its own id; ties go to the smaller id. With fewer candidates than ``k``
    all that are found are returned. Up to ``LEAF`` vectors are one leaf, and the result is exact.

    Vectors that are null, zero or hold null or non-finite components take no part,
    and neither do null ids. Every row is a candidate of its own, also where rows have
    equal ids or are equal; queries of one id share ``k`` ranks for what any of them finds.
    Shorter vectors are filled up with zeros. Other columns are ignored. Empty inputs
    give an empty result.
    """
    spark = vectors.sparkSession
    # Vectors travel and are kept as they are given; all arithmetic is in double precision.
    single = all(dict(df.dtypes)["vector"] == "array<float>" for df in (vectors, queries))
    kind = "array<float>" if single else "array<double>"

    def clean(df: DataFrame) -> DataFrame:
        some = finite(F.col("vector")) & F.exists("vector", lambda x: x != 0)
        rows = distinct_rows(df.select("vec_id", F.col("vector").cast(kind).alias("vector")), some)
        return rows.withColumn("row", F.xxhash64(F.col("vector").cast("array<double>")))

    data = kept(clean(vectors), "vectors")
    asks = kept(clean(queries), "queries")
    count, dimensions = data.agg(F.count("*"), F.max(F.size("vector"))).first()
    asked, longest = asks.agg(F.count("*"), F.max(F.size("vector"))).first()
    if not count or not asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dimensions = max(dimensions, longest)
    sample = matrix(_drawn(data, count), dimensions)
    rng = np.random.default_rng(seed)
    leaf = max(2, round(LEAF * len(sample) / count))
    grown = [grow(sample, leaf, rng) for _ in range(trees)]
    leaves = enough_leaves(grown, sample, k, recall, rng)
    forest = spark.sparkContext.broadcast([(tree.directions, tree.borders, tree.children) for tree in grown])
    sizes = _n_groups(grown)
    counted = data.mapInArrow(_census(forest, dimensions), "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    # At most GROUPS * GROUPS rows of numbers for each tree.
    counted = counted.toArrow()
    together = np.zeros((sizes[0], sum(sizes)), np.int64)
    together[counted["a"].to_numpy(), counted["b"].to_numpy()] = counted["n"].to_numpy()
    # Queries go to several blocks, vectors to one: few blocks where there are many queries.
    wanted = min(-(-count // BLOCK), max(BLOCKS, count // (4 * asked)))
    blocks = blocks_of(grown, together, max(1, min(-(-count // wanted), BLOCK_BYTES // (8 * dimensions))))
    schema = f"block int, asks boolean, place int, vec_id long, row long, copies long, vector {kind}, leaves array<int>, sure double"
    placed = data.mapInArrow(_into_blocks(forest, dimensions, blocks), schema)
    walked = asks.repartition(-(-asked // 1024), "vec_id").mapInArrow(_walks(forest, dimensions, leaves, blocks), schema)
    cells = placed.union(walked).repartition(2 * len(blocks.meets), "block").sortWithinPartitions("block", "asks", "place")
    names = "query_id long, query_row long, vec_id long, vec_row long, copies long, score double"
    return best(cells.mapInArrow(_search(forest, dimensions, k, np.float32 if single else np.float64), names), k, highest=False)


def _drawn(data: DataFrame, count: int) -> pa.Array:
    """Vectors of the rows with the ``SAMPLE`` smallest hashes, of which those beyond twice their share need no sorting."""
    mark = F.xxhash64("vec_id", "row")
    share = 2 * SAMPLE / count

    def first(rows: DataFrame) -> pa.Table:
        return rows.orderBy(mark, "vec_id").select("vector").limit(SAMPLE).toArrow()

    drawn = first(data.where(mark <= F.lit(int(share * 2**64) - 2**63))) if share < 1 else first(data)
    if len(drawn) < min(SAMPLE, count):
        drawn = first(data)
    return drawn.combine_chunks().column("vector").combine_chunks()
