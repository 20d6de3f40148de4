"""Fill-in-the-middle, decontamination and whitening against plain versions."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from conftest import bag
from pyspark.sql import functions as F

from loomframe.llm import decontamination, fill_middle, whitening
from loomframe.llm.decontamination import contamination, decontaminate
from loomframe.llm.fill_middle import SkipList, fill_in_middle, restore_texts
from loomframe.llm.whitening import eigenpairs, whitened

# fill in the middle


def plain_middle(doc_id, text):
    """By slices of the text."""
    t = text or ""
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(d[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not t or re.search("<P>|<S>|<M>", t) or h3 % 100 >= 90:
        return (doc_id, len(t), "plain", None, None, t)
    lo, hi = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
    p, m, s = t[:lo], t[lo:hi], t[hi:]
    if h4 % 100 < 20:
        return (doc_id, len(t), "spm", lo, hi - lo, f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, len(t), "psm", lo, hi - lo, f"<P>{p}<S>{s}<M>{m}")


def test_fill_middle_equals_slices(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab <>PSM\n\té学😀\0") for _ in range(rng.choice([1, 2, 17, 300]))) for _ in range(300)]
    texts += ["", None, " ", "<P>", "a<M>b", "<S", "x" * 300_000 + "😀" * 50_000]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "no id", "x"), (3, texts[3], "x"), (-7, "minus", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, output string")
    made = fill_in_middle(df, restored=True)
    assert bag(made, "doc_id", "n", "form", "prefix_chars", "middle_chars", "output") == bag_of(plain_middle(i, t) for i, t, _ in rows)
    assert made.where("restored <> coalesce(text, '') or restored is null").count() == 0
    assert {r.form for r in made.collect()} == {"plain", "psm", "spm"}
    again = restore_texts(made)
    assert again.where("restored <> coalesce(text, '')").count() == 0 and again.count() == len(rows)
    assert fill_in_middle(df.limit(0)).count() == 0


def bag_of(rows):
    out = {}
    for r in rows:
        out[r] = out.get(r, 0) + 1
    return out


@pytest.mark.parametrize("n", [0, 1, 2, 15, 16, 17, 5000])
def test_skip_list_reaches_every_rank(n):
    widths = np.random.default_rng(n).integers(1, 9, n)
    units = SkipList(widths)
    sums = np.concatenate(([0], np.cumsum(widths)))
    assert [units.place(r) for r in range(n + 1)] == sums.tolist()
    if n == 5000:
        assert len(units.points) >= 3 and len(units.points[-1]) < 200
        assert all(int(u.sum()) == n for u in units.units[1:]) and all(int(p.sum()) == sums[-1] for p in units.points)


def test_cuts_at_words(spark):
    df = spark.createDataFrame([(i, f"one two  three, {i} five", "x") for i in range(40)], "doc_id long, text string, n string")
    made = fill_in_middle(df, unit=r"\S+\s*", plain=0, restored=True).collect()
    for r in made:
        assert r.n == 5 and r.restored == r.text
        ends = [0, *(m.end() for m in re.finditer(r"\S+\s*", r.text))]
        assert r.prefix_chars in ends and r.prefix_chars + r.middle_chars in ends
    assert fill_middle.unit_widths("  ", r"\w+").tolist() == [2] and fill_middle.unit_widths("", r"\w+").tolist() == []


# decontamination


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def item_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_hits(text, items, size):
    """Number of words, places of hit words, ids of items."""
    words, places, ids = item_words(text), set(), set()
    for item, item_text in items:
        w = item_words(item_text)
        n = min(size, len(w))
        for at in range(len(w) - n + 1 if n else 0):
            for p in range(len(words) - n + 1):
                if words[p : p + n] == w[at : at + n]:
                    places |= set(range(p, p + n))
                    ids |= {str(item)} - {"None"}
    return len(words), places, ids


def contaminated_rows(rng):
    vocabulary = ["a", "B", "c", "dd", "Éé", "é", "4", "学"]
    pick = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, pick(rng.choice([4, 5, 7, 12]))) for i in range(12)] + [(None, pick(6)), (3, pick(6)), (77, ["zz"]), (78, ["q", "Q"])]
    texts = []
    for _ in range(120):
        words = pick(rng.choice([0, 1, 3, 9, 40]))
        for _ in range(rng.choice([0, 0, 1, 3])):
            at, source = rng.randint(0, len(words)), rng.choice(items)[1]
            words[at:at] = source[: rng.choice([3, 4, 5, 99])]
        texts.append("".join(w + rng.choice([" ", ", ", "\n", "--", "@["]) for w in words))
    sep = lambda w: "/ ".join(w)
    return [(i, sep(w)) for i, w in items] + [(90, ""), (91, None), (92, "?!")], texts


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("size", [4, 5])
def test_contamination_equals_brute_force(spark, monkeypatch, size, broadcast):
    if not broadcast:
        monkeypatch.setattr(decontamination, "BROADCAST_PARTS", 0)
        monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
    items, texts = contaminated_rows(random.Random(size))
    rows = [(i, t, 1) for i, t in enumerate([*texts, None, "", " \n", "ZZ", "q.q.q"])] + [(2, texts[2], 1), (2, texts[5], 1), (None, texts[7], 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_hit int")
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    expected = []
    for i, t, _ in rows:
        n, places, ids = plain_hits(t, items, size)
        starts = [p for p in sorted(places) if p - 1 not in places]
        spans = tuple((s, next(e for e in range(s, n + 1) if e not in places) - s) for s in starts)
        expected.append((i, n, len(places), tuple(sorted(ids)), spans))
    made = contamination(docs, benchmark, size).collect()
    assert bag_of((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), tuple(map(tuple, r.spans))) for r in made) == bag_of(expected)
    assert sum(e[2] > 0 for e in expected) > 30 and sum(e[2] == 0 for e in expected) > 20


def test_decontaminated_texts(spark):
    benchmark = spark.createDataFrame([(1, "B c"), (2, "d"), (3, "one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    ten = "One, two three four five six seven eight nine ten"
    texts = {
        "A b, c! d": "A ",
        "b c": "",
        " (d) e d.": " () e .",
        f"see {ten}; twelve": "see ; twelve",
        f"{ten}": "",
        f"x {ten} eleven y": "x  y",
        "two three four": "two three four",
        "": "",
        None: None,
    }
    rows = [(i, t, 5) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[0]], "doc_id long, text string, spans int")
    cleaned = decontaminate(docs, benchmark)
    assert cleaned.columns == docs.columns and bag(cleaned) == bag_of([*((i, texts[t], 5) for i, t, _ in rows), (0, "A ", 5)])
    assert contamination(cleaned, benchmark).where("n_hit > 0").count() == 0
    assert bag(decontaminate(docs, benchmark, remove="documents"), "text") == {("two three four",): 1, ("",): 1, (None,): 1}
    most = decontaminate(docs, benchmark, remove="documents", share=0.7)
    assert bag(most, "doc_id") == {(2,): 1, (6,): 1, (7,): 1, (8,): 1}
    with pytest.raises(ValueError, match="spans or documents"):
        decontaminate(docs, benchmark, remove="words")


def test_no_documents_and_no_items(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert contamination(docs.limit(0), items).count() == 0 and decontaminate(docs.limit(0), items).count() == 0
    none = contamination(docs, items.limit(0)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r["items"], r.spans) for r in none) == [(1, 2, 0, [], []), (2, 0, 0, [], [])]
    assert bag(decontaminate(docs, items.limit(0))) == {(1, "a b"): 1, (2, None): 1}


def test_long_documents_are_split_into_words_once(spark):
    long = spark.createDataFrame([(1, "one two three " * 60_000)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "two three one two three one two three one two")], "item_id long, text string")
    found = contamination(long, items).collect()[0]
    assert (found.n_words, found.n_hit) == (180_000, 179_998)


# whitening


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, vector array<double>, whitened string, n int")


def by_numpy(rows, k):
    width = max(len(v) for _, v in rows)
    x = np.array([np.pad(np.floor(256 * np.array(v, float)), (0, width - len(v))) for _, v in rows])
    fit = np.unique(x, axis=0)
    values, vectors = np.linalg.eigh(np.cov(fit.T, bias=True))
    values, vectors = values[::-1], vectors[:, ::-1]
    deviation = ((len(fit) * x.astype(np.int64) - fit.sum(axis=0).astype(np.int64)) ** 2).sum(axis=1)
    return len(fit), deviation, (x - fit.mean(axis=0)) @ vectors[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


@pytest.mark.parametrize("dimensions", [6, 60])
def test_whitening_equals_the_dense_eigenproblem(spark, dimensions):
    rng = np.random.default_rng(dimensions)
    x = rng.standard_normal((700, dimensions)) * np.linspace(1.5, 1, dimensions)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, x[5].tolist()) for i in range(300)] + [(None, x[6].tolist()), (2000, [0.5])]
    odd = [(9, None), (9, [float("nan")] * dimensions), (9, [float("inf")]), (9, [1.0, None])]
    made = whitened(frame(spark, [*rows, *odd])).collect()
    n, deviation, white, explained = by_numpy(rows, 4)
    assert len(made) == 4 * len(rows) and {r.n for r in made} == {n} and max(r.identity_error for r in made) < 1e-12
    signs = {}
    for r in made:
        at = next(k for k, (i, _) in enumerate(rows) if i == r.vec_id)
        expected = white[at, r.component - 1]
        sign = signs.setdefault(r.component, np.sign(expected * r.whitened))
        assert r.deviation == deviation[at] and abs(r.whitened - sign * expected) < 1e-9
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-12


def test_filtered_iteration_needs_few_passes():
    rng = np.random.default_rng(2)
    basis = np.linalg.qr(rng.standard_normal((200, 200)))[0]
    values = np.concatenate(([9.0, 8.0, 5.0, 5.0], np.linspace(4.5, 0.1, 196)))
    matrix, calls = basis @ np.diag(values) @ basis.T, []

    def apply(block):
        calls.append(block.shape[1])
        return matrix @ block

    found, vectors, residual = eigenpairs(apply, 200, values.sum(), 4)
    assert np.abs(found - values[:4]).max() < 1e-12 and residual <= whitening.CERTIFIED
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-12
    assert len(calls) < 100 and set(calls) == {4 + whitening.SPARE}


def test_whitening_of_few_rows(spark):
    assert whitened(frame(spark, [])).count() == 0
    assert whitened(frame(spark, [(1, None), (2, [])])).count() == 0
    assert whitened(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    line = whitened(frame(spark, [(1, [0.0, 0.0]), (2, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.component, r.n, round(abs(r.whitened), 12), round(r.explained, 12)) for r in line] == [(1, 2, 1.0, 1.0)] * 3
    assert {r.deviation for r in line} == {256**2 + 512**2}


def test_deviations_beyond_64_bits():
    x = np.array([[1 << 40, 0], [3, -4]])
    exact = [((10**6 * (1 << 40) - 5) ** 2) + 49, (3 * 10**6 - 5) ** 2 + (4 * 10**6 + 7) ** 2]
    assert whitening._deviations(x, 10**6, [5, 7]) == [e if e < 1 << 63 else None for e in exact]


def test_packed_vectors_and_sums(spark):
    rows = frame(spark, [(i, [float(i % 7), 1.0 * i]) for i in range(500)]).select(whitening.whole(F.col("vector"), 3).alias("x"))
    model = whitening.fit(rows, 2)
    x = np.array([[256 * (i % 7), 256 * i, 0] for i in range(500)])
    assert (model.n, model.sums) == (500, x.sum(axis=0).tolist()) and abs(model.trace / np.trace(np.cov(x.T, bias=True)) - 1) < 1e-12
