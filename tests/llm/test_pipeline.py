"""Every stage of the pipeline against a plain version, given the fitted models."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
import regex
from brute import shingles
from conftest import bag
from test_texts import water_level

import corpus_pipeline as pipeline
from loomframe.llm import quality, secrets
from loomframe.llm.queries import PIECES
from loomframe.llm.segmentation import Pieces, best_ways, edges

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    """The given documents with odd rows: nulls, an empty text, one id on two texts, a repeated row, secrets."""
    given = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in given.collect()]
    good = next(r[1] for r in rows if r[1] and len(r[1]) > 800)
    odd = [
        (-1, None, "en", None, None), (-2, "", None, "s", 0), (None, good, "en", "s", len(good)), (None, good, "en", "s", len(good)),
        (rows[0][0], "entirely other words under an id that stands twice", "en", "s", 50), rows[1], rows[1],
        (-3, 'set password = "hunter2024" and token=3b1f0a9c77e2d45586aa0cbb12de99f04c5d7e81 here', "en", "s", 1),
    ]
    return spark.createDataFrame(rows + odd, given.schema)


def rows_of(df) -> Counter:
    return Counter(tuple(r) for r in df.collect())


def test_quality_keeps_what_the_model_accepts(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(docs, labels)
    expected = Counter(tuple(r) for r in docs.collect() if model.score([(r.text or "").encode()])[0] >= 0.7)
    made = pipeline.keep_quality(spark, docs, SF)
    assert made.columns == docs.columns and rows_of(made) == expected and 0 < expected.total() < docs.count()


def test_one_text_of_every_group_stays(spark, docs):
    rows = [tuple(r) for r in docs.collect()]
    distinct = sorted({r for r in rows if r[0] is not None}, key=lambda r: r[0])
    sets = [shingles(r[1], 5) for r in distinct]
    group = list(range(len(distinct)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * 100 >= 80 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b):
                lo, hi = sorted((group[i], group[j]))
                group = [lo if g == hi else g for g in group]
    made = rows_of(pipeline.drop_near_duplicates(spark, docs, SF))
    assert Counter({r: n for r, n in made.items() if r[0] is None}) == Counter(r for r in rows if r[0] is None)
    known = [r for r in made.elements() if r[0] is not None]
    kept = [group[distinct.index(r)] for r in known]
    assert sorted(kept) == sorted(set(group)) and len(known) < len(distinct)
    smallest = {g: min(r[0] for r, h in zip(distinct, group, strict=True) if h == g) for g in set(group)}
    assert all(r[0] == smallest[g] for r, g in zip(known, kept, strict=True))


def test_secrets_are_replaced(spark, docs):
    forest = secrets.fit(secrets.labelled_findings(spark))
    pattern = regex.compile(secrets.CANDIDATE.replace(r"\z", r"\Z"), regex.VERSION0)
    found = secrets.with_candidates(docs.select("text")).selectExpr("inline(_listed)").distinct()
    described = secrets.describe(found).collect()
    table = np.array([[r[n] for n in secrets.NAMES] for r in described], float).reshape(-1, len(secrets.NAMES))
    votes = sum(tree.shares(table) for tree in forest) / len(forest)
    secret = {(r.text, r.before, r.after): v >= 0.5 for r, v in zip(described, votes, strict=True)}
    verdicts = {}
    for (text, _, _), is_secret in secret.items():
        verdicts.setdefault(text, set()).add(bool(is_secret))

    def plain(r):
        if r.text is None:
            return tuple(r)
        # No candidate of these texts is judged in two ways.
        text = pattern.sub(lambda m: secrets.REDACTED if verdicts[m[0]] == {True} else m[0], r.text)
        return (r.doc_id, text, r.lang, r.source, r.n_chars if text == r.text else len(text))

    assert all(len(v) == 1 for v in verdicts.values())
    made = pipeline.redact_secrets(spark, docs, SF)
    assert rows_of(made) == Counter(plain(r) for r in docs.collect())
    changed = made.where("doc_id = -3").first()
    assert "hunter2024" not in changed.text and "3b1f0a9c" not in changed.text and changed.n_chars == len(changed.text)


def test_mix_meets_its_targets_in_whole_documents(spark, docs):
    made, rows = rows_of(pipeline.mix_sources(spark, docs, SF)), rows_of(docs)
    words = lambda r: len(regex.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    sizes = [sum(n * words(r) for r, n in rows.items() if r[3] == s) for s in sources]
    targets = water_level(sizes, [(5, 2, 1)[i % 3] for i in range(len(sources))], 1.5, 2.0)
    assert set(made) <= set(rows) and all(made[r] <= 2 * n for r, n in rows.items())
    for source, target in zip(sources, targets, strict=True):
        taken = sum(n * words(r) for r, n in made.items() if r[3] == source)
        largest = max((words(r) for r in rows if r[3] == source), default=0)
        assert abs(taken - target) <= largest


def test_pieces_give_back_every_text(spark, docs):
    few = docs.where("length(text) < 1500 or text is null")
    texts = {}
    for r in few.collect():
        texts.setdefault(r.doc_id, set()).add(r.text or "")
    pieces = Pieces.load(PIECES)
    spelt = pieces.decoder()
    made = pipeline.to_pieces(spark, few, SF).collect()
    assert len(made) == few.count() > 20
    for r in made:
        text = b"".join(spelt[i] for i in r.ids).decode()[1:]
        assert r.restored and r.n_pieces == len(r.ids) and text in texts[r.doc_id]
        if 0 < len(text) < 300:
            (score, _), *_ = best_ways(edges(" " + text, pieces), 1)
            assert score == pytest.approx(r.nbest_scores[0])


def test_run_is_its_stages_and_ignores_no_column(spark, tmp_path):
    """Written and read between stages; further columns of clashing names do no harm."""
    given = spark.read.parquet(f"{SF}/documents.parquet")
    given.selectExpr("*", "'x' AS content", "1 AS predicted", "2 AS _id", "3 AS component", "4 AS copies", "5 AS findings").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    plain, wide = pipeline.run(spark, SF), pipeline.run(spark, str(tmp_path))
    assert wide.columns == plain.columns
    assert bag(wide, "doc_id", "n_pieces") == bag(plain, "doc_id", "n_pieces")
