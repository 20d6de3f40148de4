from __future__ import annotations

import os
import sys
import tracemalloc
from types import SimpleNamespace

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest import final_plan
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "scripts"))

from compare import mismatch  # noqa: E402

from loomframe.llm import cells, inner_products, rp_forest  # noqa: E402
from loomframe.llm.inner_products import top_inner_products  # noqa: E402
from loomframe.llm.queries import ORACLES, QUERIES  # noqa: E402
from loomframe.llm.rp_forest import nearest  # noqa: E402

VECTORS = "vec_id long, vector array<double>, score string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], VECTORS)


def clustered(n: int, seed: int = 1) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, 16)) * 3
    x = centres[rng.integers(0, 12, n)] + rng.standard_normal((n, 16))
    x[10:14] = x[3]
    return [(i, v.tolist()) for i, v in enumerate(x)]


ODD = [
    (9001, None), (9002, []), (9003, [0.0] * 16), (9004, [float("nan")] * 16), (9005, [1.0, None]),
    (9006, [float("inf")] + [0.0] * 15), (None, [1.0] * 16), (9007, [1.0, 2.0]),
]


def by_distance(rows, query, k):
    usable = [(i, np.pad(np.array(v, float), (0, 16 - len(v)))) for i, v in rows if i is not None and v and None not in v]
    usable = [(i, v) for i, v in usable if np.isfinite(v).all() and v.any()]
    own = dict(usable)[query]
    return sorted((float(np.sqrt(((v - own) ** 2).sum())), i) for i, v in usable if i != query)[:k]


def test_nearest_finds_most_true_neighbours_with_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(rp_forest, "LEAF", 64)
    monkeypatch.setattr(cells, "VECTORS", 50)
    rows = [*clustered(3000), *ODD]
    df = frame(spark, rows)
    found = nearest(df, df.where("vec_id % 100 = 0 or vec_id > 9000"), k=10).collect()
    hits = total = 0
    for q in {r.query_id for r in found}:
        true = by_distance(rows, q, 10)
        got = sorted((r["rank"], r.vec_id, r.score) for r in found if r.query_id == q)
        assert [g[0] for g in got] == list(range(1, 11))
        assert [(s, i) for _, i, s in got] == sorted((s, i) for _, i, s in got)
        exact = {i: d for d, i in by_distance(rows, q, 5000)}
        assert all(exact[i] == s for _, i, s in got)
        hits += len({i for _, i, _ in got} & {i for _, i in true})
        total += 10
    assert {r.query_id for r in found} == {*range(0, 3000, 100), 9007}
    assert hits / total >= 0.9


def test_few_vectors_and_none(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (3, [0.0, 1.0])]
    found = nearest(frame(spark, rows), frame(spark, rows[:1]), k=10).collect()
    assert [(r["rank"], r.vec_id, round(r.score, 6)) for r in found] == [(1, 2, 0.0), (2, 3, 1.414214), (3, 3, 1.414214)]
    assert nearest(frame(spark, []), frame(spark, rows)).count() == 0
    assert nearest(frame(spark, rows), frame(spark, [])).count() == 0


@pytest.mark.parametrize("shape", ["mixed", "ties"])
def test_inner_products_equal_brute_force(spark, monkeypatch, shape):
    for module, name, value in ((inner_products, "BLOCK", 100), (inner_products, "STEP", 16), (cells, "QUERIES", 3)):
        monkeypatch.setattr(module, name, value)
    rng = np.random.default_rng(2)
    x = rng.integers(-900, 900, (700, 12)) * rng.integers(1, 5, (700, 1))
    if shape == "ties":
        x = rng.integers(0, 2, (700, 12))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x.tolist())]
    extra = [(-1, None), (-2, [1.0, None]), (None, [1.0] * 12), (-4, [0.0] * 12), (-5, [3.0])]
    df = frame(spark, [*rows, *extra]).select("vec_id", F.col("vector").cast("array<long>").alias("vector"), "score")
    found = top_inner_products(df, df.where("vec_id % 50 = 0 or vec_id < 0"), k=10).collect()
    whole = {i: np.array(v) for i, v in rows} | {-4: np.zeros(12), -5: np.array([3.0] + [0.0] * 11)}
    expected = set()
    for q in [*range(0, 700, 50), -4, -5]:
        ranked = sorted((-int(v @ whole[q]), i) for i, v in whole.items() if i != q)[:10]
        expected |= {(q, n, i, -s) for n, (s, i) in enumerate(ranked, 1)}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in found} == expected


def test_inner_products_of_few_and_none(spark):
    df = frame(spark, [(1, [1.0]), (2, [2.0]), (5, [-3.0])])
    found = top_inner_products(df, df.where("vec_id = 2"), k=10).collect()
    assert [(r["rank"], r.vec_id, r.score) for r in found] == [(1, 1, 2), (2, 5, -6)]
    assert top_inner_products(df.limit(0), df).count() == 0
    assert top_inner_products(df, df.limit(0)).count() == 0


def with_repeats(n: int, seed: int) -> list[tuple]:
    """Ids that stand on several rows, some of them equal."""
    rng = np.random.default_rng(seed)
    rows = [(int(rng.integers(0, n // 2)), [float(c) for c in rng.integers(-4, 5, 6)]) for _ in range(n)]
    return rows + rows[:20] + [rows[3]] * 15 + [(100, rows[0][1]), (100, rows[1][1]), (100, rows[1][1])]


def all_pairs(rows, score):
    """Ranks of every query id over all pairs of rows of different ids."""
    out = {}
    for q, x in rows:
        if q % 100 == 0:
            out.setdefault(q, []).extend((score(np.array(x), np.array(v)), i) for i, v in rows if i != q)
    return {(q, n, i, s) for q, found in out.items() for n, (s, i) in enumerate(sorted(found)[:10], 1)}


@pytest.mark.parametrize("seed", [1, 2])
def test_rows_of_equal_ids_are_all_candidates(spark, monkeypatch, seed):
    for module, name, value in ((inner_products, "BLOCK", 60), (inner_products, "TILE", 2), (cells, "VECTORS", 40), (cells, "QUERIES", 2)):
        monkeypatch.setattr(module, name, value)
    rows = with_repeats(400, seed)
    df = frame(spark, rows)
    queries = df.where("vec_id % 100 = 0")
    whole = df.select("vec_id", F.col("vector").cast("array<long>").alias("vector"))
    found = top_inner_products(whole, whole.where("vec_id % 100 = 0"), k=10).collect()
    expected = all_pairs(rows, lambda a, b: -int(a @ b))
    assert {(r.query_id, r["rank"], r.vec_id, -r.score) for r in found} == expected and len(found) == len(expected)
    usable = [(i, v) for i, v in rows if any(v)]
    found = nearest(df, queries, k=10).collect()
    expected = all_pairs(usable, lambda a, b: float(np.sqrt(((a - b) ** 2).sum())))
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in found} == expected and len(found) == len(expected)


def test_inner_products_of_repeated_ids_equal_the_sql(spark, tmp_path):
    rows = [(i, [float(c) / 8 for c in v]) for i, v in with_repeats(300, 5)] + [(None, [1.0] * 6), (100, None), (7, [float("nan")] * 6)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert mismatch(QUERIES["op10_inner_products"](spark, str(tmp_path)).toArrow(), con.sql(ORACLES["op10_inner_products"]).to_arrow_table()) is None


def test_scores_beyond_what_doubles_hold(spark):
    big = 1 << 30
    rows = [(0, [big, 1]), (1, [big, 3]), (2, [big, 2]), (3, [big, 3])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    found = top_inner_products(df, df.where("vec_id = 0"), k=2).collect()
    assert [(r.vec_id, r.score) for r in found] == [(1, big * big + 3), (3, big * big + 3)]


def test_a_cell_of_wide_vectors_stays_small():
    rng = np.random.default_rng(1)
    queries, vectors = rng.integers(-900, 900, (4096, 768)), rng.integers(-900, 900, (4096, 768))
    find = inner_products._top(10, np.eye(768))()
    tracemalloc.start()
    q, v, s = find(np.arange(4096), queries, np.full(4096, np.nan), np.arange(4096) + 5000, vectors)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(q) == 40_960 and peak < 500_000_000
    assert (s == np.einsum("ij,ij->i", queries[q], vectors[v])).all()


def test_no_query_meets_every_block(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    plan = QUERIES["op10_inner_products"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert vectors.count() and "NestedLoop" not in plan and "Cartesian" not in plan


def test_queries_of_the_forest_are_not_sent_leaf_by_leaf(spark, monkeypatch):
    monkeypatch.setattr(rp_forest, "LEAF", 8)
    df = frame(spark, clustered(3000))
    found = nearest(df, df.where("vec_id % 100 = 0"), k=10)
    plan = final_plan(found)
    assert "Broadcast" not in plan and "Join" not in plan and found.count() == 300
    trees = [rp_forest.grow(np.random.default_rng(t).standard_normal((3000, 16)), 8, np.random.default_rng(t)) for t in range(4)]
    rng = np.random.default_rng(9)
    together = rng.integers(1, 3, (rp_forest._n_groups(trees)[0], sum(rp_forest._n_groups(trees))))
    blocks = rp_forest.blocks_of(trees, together, 20)
    vectors = pa.array(rng.standard_normal((500, 16)).tolist())
    numbers = [pa.array(np.arange(500)) for _ in range(3)]
    batch = pa.RecordBatch.from_arrays([*numbers, vectors], names=["vec_id", "row", "copies", "vector"])
    arrays = SimpleNamespace(value=[(t.directions, t.borders, t.children) for t in trees])
    sent = [b.num_rows for b in rp_forest._walks(arrays, 16, 900, blocks)([batch])]
    # Every walk has 900 leaves; it used to send its query to each of them, all queries of a batch at once.
    assert sum(sent) <= 500 * len(blocks.meets) < 500 * 900 and max(sent) <= 256 * len(blocks.meets)


@pytest.mark.parametrize("kind", ["random", "clustered", "lattice", "same"])
@pytest.mark.parametrize("leaf", [2, 30, 5000])
def test_leaves_of_many_queries_are_those_of_their_walks(kind, leaf):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1500, 8))
    if kind == "clustered":
        x = rng.standard_normal((6, 8))[rng.integers(0, 6, 1500)] * 5 + x / 10
    if kind == "lattice":
        x = rng.integers(0, 3, (1500, 8)).astype(float)
    if kind == "same":
        x[:] = x[0]
    trees = [rp_forest.grow(x, leaf, rng) for _ in range(4)]
    first = np.cumsum([0] + [len(t.borders) + 1 for t in trees])
    queries = x[:20] + rng.standard_normal((20, 8)) / 10
    for n in (1, 3, max(1, int(first[-1]) // 5), int(first[-1]), int(first[-1]) + 4):
        reached, sure, ties = rp_forest.first_leaves(trees, queries, n)
        for q, v in enumerate(queries):
            assert set(np.flatnonzero(reached[:, q]).tolist()) == {int(first[t]) + i for t, i in rp_forest.walk(trees, v, n)}
        assert (rp_forest.again(trees, queries[3:9], sure[3:9], ties[3:9]) == reached[:, 3:9]).all()


@pytest.mark.parametrize("kind", ["double", "float"])
def test_blocks_of_the_forest_find_what_all_pairs_do(spark, monkeypatch, kind):
    for name, value in (("LEAF", 16), ("GROUPS", 4), ("BLOCK", 50), ("BLOCK_BYTES", 60 * 8 * 6), ("STEP", 32), ("PAIRS", 50), ("TABLE", 64)):
        monkeypatch.setattr(rp_forest, name, value)
    # With all leaves nothing is left out, so that every cut and every way has to be right.
    monkeypatch.setattr(rp_forest, "enough_leaves", lambda forest, *_: sum(len(t.borders) + 1 for t in forest))
    rows = with_repeats(600, 7) + [(i, [2.0, 1.0, 0.0, 0.0, 0.0, 3.0]) for i in range(1000, 1150)]
    df = frame(spark, rows).withColumn("vector", F.col("vector").cast(f"array<{kind}>"))
    found = nearest(df, df.where("vec_id % 100 = 0"), k=10).collect()
    expected = all_pairs([(i, v) for i, v in rows if any(v)], lambda a, b: float(np.sqrt(((a - b) ** 2).sum())))
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in found} == expected and len(found) == len(expected)


def test_a_forest_that_reaches_few_leaves_ranks_what_is_in_them(spark, monkeypatch):
    for name, value in (("LEAF", 16), ("GROUPS", 8), ("BLOCK", 100), ("STEP", 64)):
        monkeypatch.setattr(rp_forest, name, value)
    grown = []
    monkeypatch.setattr(rp_forest, "enough_leaves", lambda forest, *_: grown.append(forest) or 40)
    rows = clustered(2000)
    df = frame(spark, rows)
    found = nearest(df, df.where("vec_id % 100 = 0"), k=10).collect()
    x = np.array([v for _, v in rows])
    placed = [t.leaves(x) for t in grown[0]]
    expected = set()
    for q in range(0, 2000, 100):
        seen = {int(i) for t, leaf in rp_forest.walk(grown[0], x[q], 40) for i in np.flatnonzero(placed[t] == leaf)} - {q}
        assert len(seen) < 1500
        ranked = sorted((float(np.sqrt(((x[i] - x[q]) ** 2).sum())), i) for i in seen)[:10]
        expected |= {(q, n, i, s) for n, (s, i) in enumerate(ranked, 1)}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in found} == expected


def test_distances_that_doubles_can_hold_but_squares_cannot(spark):
    rows = [(0, [1e200, 1.0]), (1, [1e200, 4.0]), (2, [1e200, 2.0]), (3, [-1e200, 1.0]), (4, [1.0, 1.0])]
    found = nearest(frame(spark, rows), frame(spark, rows[:1]), k=4).collect()
    assert [(r.vec_id, r.score) for r in found] == [(2, 1.0), (1, 3.0), (3, float("inf")), (4, float("inf"))]


def test_equal_vectors_of_the_forest_are_dealt_out():
    trees = [rp_forest.grow(np.ones((100, 4)), 10, np.random.default_rng(1)) for _ in range(4)]
    blocks = rp_forest.blocks_of(trees, np.full((1, 4), 1000), 100)
    ids = pa.array(np.arange(0, 100_000, 100))
    columns = [ids, pa.array(np.full(1000, -7)), pa.array(np.ones(1000, np.int64)), pa.array([[1.0] * 4] * 1000)]
    batch = pa.RecordBatch.from_arrays(columns, names=["vec_id", "row", "copies", "vector"])
    arrays = SimpleNamespace(value=[(t.directions, t.borders, t.children) for t in trees])
    (sent,) = rp_forest._into_blocks(arrays, 4, blocks)([batch])
    sizes = np.bincount(sent.column("block").to_numpy(), minlength=10)
    assert len(sizes) == len(blocks.meets) == 10 and sizes.min() > 50 and sizes.max() < 150
