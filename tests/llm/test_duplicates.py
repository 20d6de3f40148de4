from __future__ import annotations

import random

import numpy as np
import pytest
from brute import near_duplicates as plain
from brute import repeated_bytes, shingles
from conftest import bag

from loomframe.llm import lsh_forest, suffix_dedup
from loomframe.llm.components import components
from loomframe.llm.lsh_forest import near_duplicates


def corpus(seed: int, n: int = 60) -> list[tuple]:
    """Texts with exact and near copies, passages in common, and odd rows."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [[rng.choice(words) for _ in range(rng.randint(1, 90))] for _ in range(n // 3)]
    rows = []
    for i in range(n):
        text = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((1000 - 7 * i, rng.choice([" ", "\t", " \n "]).join(text).replace("w1", rng.choice(["w1", "W1"]))))
    return [*rows, (5, None), (6, ""), (8, " \t\n"), (9, "one"), (11, "ONE"), (12, "Öne"), rows[3], rows[3], (None, "one")]


@pytest.mark.parametrize(("size", "percent", "seed"), [(3, 85, 1), (5, 80, 2)])
def test_near_duplicates_equal_brute_force(spark, size, percent, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, kept int, component_id string")
    expected = plain(rows, size, percent)
    found = near_duplicates(df, size, percent).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == expected[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)


def test_large_regions_are_cut_and_stay_whole(spark, monkeypatch):
    """Blocks of a few rows: a large group of near copies, and one whose members are just too far apart."""
    monkeypatch.setattr(lsh_forest, "BLOCK", 4)
    rng = random.Random(4)
    one, two = ([f"{c}{i}" for i in range(60)] for c in "ab")
    rows = []
    for i in range(60):
        text = list(one if i % 2 else two)
        for p in rng.sample(range(60), 1 if i % 2 else 3):
            text[p] = f"z{i}{p}"
        rows.append((i, " ".join(text)))
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == plain(rows, 3, 85)


def test_neighbours_of_sorted_orders_find_most_links(spark, monkeypatch):
    """Of the documents that links tie to another one, the prefix neighbours alone tie at least nine tenths."""
    rows = corpus(7, 240)
    seen = []
    monkeypatch.setattr(lsh_forest, "components", lambda links: seen.append(components(links)) or seen[-1])
    near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).count()
    first, second = ([len(r), len({x.component for x in r})] for r in (seen[0].collect(), seen[1].collect()))
    tied, later = first[0] - first[1], second[0] - second[1]
    assert tied > 20 and tied >= 0.9 * (tied + later)


def by_id(rows: list[tuple], size: int, percent: int) -> dict:
    """doc_id -> smallest id that links of any of its texts lead to."""
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, set()).add(shingles(t, size))
    reach = {i: i for i in sets}
    linked = [
        (a, b)
        for a in sets
        for b in sets
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b])
    ]
    for _ in sets:
        for a, b in linked:
            reach[b] = min(reach[a], reach[b])
    return reach


def test_links_of_all_texts_of_an_id(spark):
    a, b = ("the quick brown fox jumps over the lazy dog " * 3).split(), [f"w{i}" for i in range(30)]
    text = " ".join
    rows = [(5, text(a)), (5, text(b)), (7, text(a + ["x"])), (9, text([*b[:-1], "y"]))]
    found = bag(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 80), "doc_id", "component_id", "kept")
    assert found == {(5, 5, True): 2, (7, 5, False): 1, (9, 5, False): 1}


@pytest.mark.parametrize("seed", [3, 4])
def test_repeated_ids_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([i, i % 50, 3]), t) for i, t in corpus(seed, 90) if i is not None] + [(None, "one")]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 80).collect()
    expected = by_id(rows, 3, 80)
    assert len(found) == len(rows)
    empty = {i for i, t in rows if not shingles(t, 3)}
    for r in found:
        if r.doc_id is not None and r.n_shingles:
            assert r.component_id == expected[r.doc_id], r
        elif r.doc_id in empty:
            assert r.component_id == r.doc_id and r.kept


def test_representatives_keep_a_text_of_every_group(spark):
    a, b = ("the quick brown fox jumps over the lazy dog " * 4).split(), [f"w{i}" for i in range(40)]
    text = " ".join
    rows = [
        (5, text(a), 1), (5, text(b), 2), (7, text([*a, "x"]), 3), (9, text([*b, "y"]), 4), (5, text(a), 1), (11, "alone", 5),
        (12, None, 6), (12, None, 6), (13, "", 7), (None, text(a), 8), (None, text(a), 8), (12, "other", 9),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, content int")
    kept_rows = bag(lsh_forest.representatives(docs))
    assert kept_rows == {rows[0]: 1, rows[1]: 1, rows[5]: 1, rows[6]: 1, rows[8]: 1, rows[9]: 2, rows[11]: 1}
    assert lsh_forest.representatives(docs.limit(0)).count() == 0


def test_near_duplicates_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    found = near_duplicates(empty)
    assert found.count() == 0 and found.columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_limits_of_the_forest():
    assert lsh_forest.least_depth(85) == 4 and lsh_forest.least_depth(80) == 3
    miss = (1 - 0.85 ** lsh_forest.least_depth(85)) ** lsh_forest.TREES
    assert miss <= lsh_forest.MISS
    assert 90 < lsh_forest.least_matches(80) < lsh_forest.least_matches(85) < 0.85 * 160


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(200, 260)]
    links = [*chain, *star, (3, 3), (None, 4), (8, 7), (7, 8), (500, 501)]
    found = bag(components(spark.createDataFrame(links, "a long, b long")))
    expected = {(i, 100): 1 for i in range(100, 141)} | {(i, 7): 1 for i in (7, 8, *range(200, 260))}
    assert found == expected | {(500, 500): 1, (501, 500): 1}


def texts_with_repeats(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé \n") for _ in range(rng.randint(1, 9)))
    passage = [" ".join(word() for _ in range(60)) for _ in range(4)]
    rows = []
    for i in range(40):
        own = " ".join(word() for _ in range(rng.randint(0, 80)))
        parts = [own, *rng.sample(passage, rng.choice([0, 1, 1, 2])), own[:150]]
        rows.append((i, "".join(parts)))
    return [
        *rows, rows[0], (100, "ab" * 300), (101, "x" * 201), (102, "x" * 200 + "y"), (103, None), (104, ""),
        (105, "q" * 199), (105, "q" * 199), (None, "ab" * 120), (106, passage[0][:200]),
    ]


@pytest.mark.parametrize(("large", "piece"), [(suffix_dedup.LARGE, suffix_dedup.PIECE), (1, 70), (suffix_dedup.LARGE, 33)])
def test_repeated_spans_equal_brute_force(spark, monkeypatch, large, piece):
    monkeypatch.setattr(suffix_dedup, "LARGE", large)
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    rows = texts_with_repeats(3)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, doc string, spans int")
    found = suffix_dedup.repeated_spans(df.repartition(3))
    digests = bag(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert digests == repeated_bytes(rows)
    for r in found.collect():
        assert sum(s.hi - s.lo for s in r.spans) == r.n_removed and len(r.spans) == r.n_spans


def test_repeated_spans_of_nothing(spark):
    assert suffix_dedup.repeated_spans(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_window_buckets_are_the_equal_windows():
    rng = random.Random(9)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.choice([150, 230, 260]))) for _ in range(6)]
    texts += [texts[1] + b"a", b"a" * 260]
    bucket, owner, start = suffix_dedup.window_buckets(texts)
    windows = [texts[o][s : s + 200] for o, s in zip(owner.tolist(), start.tolist(), strict=True)]
    assert len(windows) == sum(max(0, len(t) - 199) for t in texts)
    numbers = dict(zip(windows, bucket.tolist(), strict=True))
    assert [numbers[w] for w in windows] == bucket.tolist() and len(set(numbers.values())) == len(numbers)


def test_sliding_minimum():
    values = np.random.default_rng(1).integers(0, 50, 500).astype(np.uint64)
    for width in (1, 7, 176, 500):
        expected = [values[i : i + width].min() for i in range(len(values) - width + 1)]
        assert suffix_dedup.sliding_minimum(values, width).tolist() == expected
