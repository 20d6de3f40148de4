from __future__ import annotations

import itertools
import math
import random
import time

import numpy as np
import pytest
from conftest import bag
from pyspark.sql import functions as F

from loomframe.llm import html_text, mixing, quality, segmentation
from loomframe.llm.html_text import main_text
from loomframe.llm.queries import PIECES, table

SF = "/root/testdata/sf0.01"

PAGES = [
    (None, ""),
    ("", ""),
    ("no markup at all", "no markup at all"),
    ("<p>one <b>bold</b>\n\tand   more<p>two &amp; &#8364; &lt;x&gt;", "one bold and more\ntwo & € <x>"),
    ("<nav><a href=/>Home</a></nav><article><header><h1>T</h1></header><p>a<br>b</p></article><footer>f</footer>", "T\na b"),
    ("<body><div id=main><p>" + "long text " * 30 + "</p><p>end</p></div><div class='sidebar'>side</div></body>", ("long text " * 30).strip() + "\nend"),
    ("<article><p>keep</p><div class=\"comments\"><p>bad</p></div><aside>x</aside><form>y</form><p>this</p></article>", "keep\nthis"),
    ("<article><p>cut off <b>here", "cut off here"),
    ("<script>var t='<p>no</p>'</script><style>p{}</style><!-- <p>no</p> --><p>yes</p>", "yes"),
    ("<article><p>5 < 6 &copy b</p><ul><li>item one<li>item two</ul></article>", "5 < 6 © b\nitem one\nitem two"),
    ('<article><p title="a > b">quoted</p><p hidden>no</p><div role="navigation">no</div></article>', "quoted"),
    ("<title>t</title>", ""),
    ("<article><p><a href=x>all linked</a></p></article><article class='comment'><p>me too</p></article>", "all linked"),
    ("<ul><li><a href=x>Menu entry</a></ul><div><p>" + "words " * 9 + "</p></div>", ("words " * 9).strip()),
    # What stands in a quoted value is no attribute.
    ('<p title="the hidden gem">keep me</p><p data-x="a class=ad b">me too</p><p hidden>no</p>', "keep me\nme too"),
    ("<div role='main'><p>in</p></div><div><p>out</p></div>", "in"),
    # Names of wrappers and of sections that merely sound like parts beside the article.
    ('<div class="has-sidebar"><article><p>a</p></article></div>', "a"),
    ('<div id="page" class="with-comments"><p>a</p><div class="comments"><p>no</p></div></div>', "a"),
    ('<section id="search-results-explained"><p>a</p></section>', "a"),
    ('<article><div class="no-footer"><p>a</p></div><h2 id="related-work">b</h2><p>c</p></article>', "a\nb\nc"),
    ('<body><form action=x><div><p>a</p><input><p>b</p></div><div class="menu"><p>no</p></div></form></body>', "a\nb"),
    ('<div class="modal"><article><p>a</p><div class="share-buttons">no</div></article></div>', "a"),
    ('<div class="sidebar"><article><p>teaser</p></article></div><article><p>a</p></article>', "a"),
    ('<article><div class="entry-header"><p>by me</p></div><div class="site-header"><p>no</p></div><p>a</p></article>', "by me\na"),
    ('<div class="related-posts"><p>no</p></div><div class="comment-list"><p>no</p></div><p>a</p>', "a"),
    ("<div class=menu><p>only a menu</p></div>", ""),
    # A short last section behind adverts stays.
    ("<p>" + "long " * 80 + "</p>" + '<div class="ad">x</div>' * 4 + "<p>short end</p>", ("long " * 80).strip() + "\nshort end"),
    # One or two linked lines between lines of text belong to it; three and more, or those at an end, are a menu.
    ("<p>a</p><p><a href=x>b</a></p><p><a href=x>c</a></p><p>d</p>" + "<p><a href=x>no</a></p>" * 3 + "<p>e</p><p><a href=x>no</a></p>", "a\nb\nc\nd\ne"),
    ("<article><p>a</p><ul>" + "<li><a href=x>no</a>" * 5 + "</ul><p>b</p><ul><li><a href=x>c</a></ul><p>d</p></article>", "a\nb\nc\nd"),
    ("<article><ul>" + "<li><a href=x>link</a>" * 4 + "</ul></article>", "\n".join(["link"] * 4)),
    ("<article><p>a</p><p><a href=x>b</a></p><p><a href=x>c</a></p><p><a href=x>d</a></p><p>e</p></article>", "a\nb\nc\nd\ne"),
]


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_main_text(page, text):
    assert main_text(page) == text


def test_broken_markup_takes_linear_time():
    begin = time.process_time()
    for page in ('<a "' * 100_000, "<" * 200_000, "<!--" * 50_000, "<p>" * 30_000, "<div>" * 30_000 + "x", "&" * 200_000, "<p " + "a " * 100_000 + ">x", "<p " + "a= " * 100_000 + ">x", "<p " + "'" * 100_001 + ">x"):
        main_text(page)
    assert time.process_time() - begin < 30


def test_extract_keeps_rows_and_ignores_clashing_columns(spark):
    rows = [(1, "u", "<p>é😀</p>", "x"), (1, "u", "<p>é😀</p>", "x"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert bag(html_text.extract(df)) == {(1, "u", "é😀", 2): 2, (None, None, "", 0): 1}
    assert html_text.extract(df.limit(0)).count() == 0


def test_article_text_of_all_pages(spark):
    """The pages of the test tables mark their article; its blocks are the whole result."""
    import html
    import re

    pages = table(spark, SF, "pages")
    made = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " ", b))).strip() for b in re.split(r"</?p>|</?h1>", body)]
        assert made[r.page_id] == "\n".join(b for b in blocks if b)


def test_quality_on_held_out_rows(spark):
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels").withColumn("held_out", quality.held_out(F.col("doc_id")))
    model = quality.fit(docs, labels.where("not held_out"))
    scored = quality.score_quality(docs, model).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.quality for r in scored)
    assert len(scored) > 50 and right / len(scored) >= 0.97
    good, bad = ([r.score for r in scored if r.quality == q] for q in (1, 0))
    assert sum(g > b for g, b in itertools.product(good, bad)) / (len(good) * len(bad)) > 0.99


def test_quality_of_odd_rows_and_without_labels(spark):
    rows = [(1, "fine words here", 3.0), (2, None, 1.0), (2, "", 1.0), (None, " \n", 0.0), (4, "w " * 100_000, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    none = spark.createDataFrame([(1, None), (None, 1), (9, 1), (1, 7)], "doc_id long, quality int")
    model = quality.fit(docs, none)
    scored = quality.score_quality(docs, model).collect()
    assert {r.score for r in scored} == {0.5} and {r.predicted for r in scored} == {0}
    trained = quality.train([quality.bag(b"good"), quality.bag(b"bad !!")], np.array([1, 0]))
    scored = quality.score_quality(docs, trained)
    assert scored.columns == ["doc_id", "text", "score", "predicted"] and scored.where("score between 0 and 1").count() == 5
    empty = {r.score for r in scored.collect() if not (r.text or "").strip()}
    assert len(empty) == 1
    assert quality.score_quality(docs.limit(0), trained).count() == 0
    assert trained.score([b"a b", b"c"])[1] == trained.score([b"c"])[0]


def water_level(sizes: list[int], weights: list[float], share: float, most: float) -> list[float]:
    left, open_ = share * sum(sizes), set(range(len(sizes)))
    out = [0.0] * len(sizes)
    while open_:
        level = left / sum(weights[i] for i in open_)
        above = [i for i in open_ if level * weights[i] > most * sizes[i]]
        if not above:
            for i in open_:
                out[i] = level * weights[i]
            return out
        for i in above:
            out[i] = most * sizes[i]
            left -= out[i]
            open_.remove(i)
    return out


def test_mixing_meets_targets(spark):
    rng = random.Random(5)
    sources = ["b", "a", "ä", None, "Z", "tiny", "none"]
    rows = []
    for i in range(3000):
        source = rng.choice(["b"] * 6 + sources[:5])
        rows.append((i, " \t".join("w" * 3 for _ in range(rng.choice([0, 3, 8, 20, 90]))), source, 1))
    rows += [(5000, "one", "tiny", 1), (5001, None, "none", 1), (None, "x y", "a", 1), rows[7], rows[7]]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    found = mixing.mix(df).collect()
    assert len(found) == len(rows)
    size = {i: len((t or "").split()) for i, t, _, _ in rows}
    order = ["Z", "a", "b", "none", "tiny", "ä", None]
    totals = [sum(len((t or "").split()) for _, t, s, _ in rows if s == o) for o in order]
    goals = dict(zip(order, water_level(totals, [5, 2, 1, 5, 2, 1, 5], 1.5, 2.0), strict=True))
    of = {i: s for i, _, s, _ in rows}
    taken = dict.fromkeys(order, 0)
    for r in found:
        assert r.size == size[r.doc_id] and 0 <= r.taken <= 2 * r.size
        assert math.isclose(r.target, goals[of[r.doc_id]], rel_tol=1e-12)
        assert r.source_size == totals[order.index(of[r.doc_id])]
        taken[of[r.doc_id]] += r.taken
    assert all(abs(taken[o] - goals[o]) <= 1 for o in order)
    again = mixing.mix(df.repartition(5)).collect()
    key = lambda rs: sorted((str(r.doc_id), r.taken) for r in rs)
    assert key(found) == key(again)


def test_flight_keeps_both_sums():
    rng = random.Random(3)
    sizes = [float(rng.choice([1, 2, 5, 5, 80])) for _ in range(200)]
    chances = [0.3] * 200
    draws = iter([rng.random() for _ in range(500)])
    out = mixing.flight(sizes, chances, draws)
    assert sum(0 < x < 1 for x in out) <= 2
    assert math.isclose(sum(out), 60) and math.isclose(sum(s * x for s, x in zip(sizes, out, strict=True)), 0.3 * sum(sizes))
    landed = mixing.landing(sizes, out, draws, part=False)
    assert set(landed) <= {0.0, 1.0}


def test_flight_keeps_chances_on_average():
    rng = np.random.default_rng(1)
    total = np.zeros(6)
    for _ in range(3000):
        total += mixing.landing([1.0, 4.0, 2.0, 2.0, 9.0, 3.0], [0.2, 0.5, 0.5, 0.7, 0.4, 0.3], iter(rng.random(30).tolist()), False)
    assert np.abs(total / 3000 - [0.2, 0.5, 0.5, 0.7, 0.4, 0.3]).max() < 0.04


def test_take_repeats_whole_rows(spark):
    rows = [(i, "a b c", "s" if i % 2 else "t", i) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")
    found = mixing.take(df)
    assert found.columns == df.columns
    counts = {r.doc_id: r["count"] for r in found.groupBy("doc_id").count().collect()}
    assert set(counts.values()) <= {1, 2} and found.count() == pytest.approx(150, abs=2)
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.take(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def pieces():
    return segmentation.Pieces.load(PIECES)


def all_ways(text: str, pieces, n: int) -> list[float]:
    ending = segmentation.edges(" " + text, pieces)
    found = []

    def go(place: int, score: float) -> None:
        if place == 0:
            found.append(score)
        for start, gain, _ in ending[place]:
            go(start, score + gain)

    go(len(ending) - 1, 0.0)
    return sorted(found, reverse=True)[:n]


def test_n_best_equal_all_segmentations(pieces):
    rng = random.Random(1)
    encoder = segmentation.Encoder(pieces, 4)
    decoder = pieces.decoder()
    for _ in range(150):
        text = "".join(rng.choice("the an xqz \n▁é学😀  .3") for _ in range(rng.randint(1, 11)))
        flat, _, ranked = encoder.encode([text])
        assert segmentation.decode(flat.tolist(), decoder) == text
        assert [r["score"] for r in ranked[0]] == all_ways(text, pieces, 4)
        ways = {tuple((s["unit"], *s["ids"]) for s in r["swaps"]) for r in ranked[0]}
        assert len(ways) == len(ranked[0])


def test_texts_come_back_exactly(spark):
    long = "word " * 20_000 + "a" * 3000
    rows = [(1, None), (2, ""), (3, " "), (4, "  a\n\n b "), (5, "▁ \0\t"), (6, "a\r\n😀"), (7, long), (7, long)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, ids string")
    docs = docs.unionByName(table(spark, "/root/testdata/sf0.001", "documents").selectExpr("doc_id", "text", "'' AS ids"))
    made = segmentation.decode_ids(segmentation.encode_texts(docs, PIECES), PIECES)
    at_once = segmentation.encode_texts(docs, PIECES, decoded=True)
    assert at_once.where("decoded <> coalesce(text, '') or decoded is null").count() == 0
    assert made.columns == ["doc_id", "text", "ids", "score", "nbest", "decoded"]
    assert made.where("decoded <> coalesce(text, '')").count() == 0 and made.count() == docs.count()
    assert made.where("doc_id in (1, 2) and text is null and size(ids) = 0 and size(nbest) = 1").count() == 1
    assert made.where("nbest[0].score <> score or nbest[0].score < get(nbest, 1).score").count() == 0
    assert segmentation.encode_texts(docs.limit(0), PIECES).count() == 0


def test_ties_of_a_long_unit_are_not_all_followed(pieces):
    begin = time.process_time()
    flat, _, ranked = segmentation.Encoder(pieces, 3).encode(["a" * 20_000])
    assert time.process_time() - begin < 30 and len(ranked[0]) == 3
    assert segmentation.decode(flat.tolist(), pieces.decoder()) == "a" * 20_000
