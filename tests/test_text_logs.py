from __future__ import annotations

import pytest
from conftest import bag, values
from pyspark.sql import functions as F

from loomframe import functions as fn
from loomframe.plans import graph, logs


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


SENTENCES = ["Nebel zieht auf", "", "  the ferry at seven , the last one ", "É\tà"]


def test_words_and_lengths(spark):
    df = lines(spark, *SENTENCES)
    expected = [w for s in SENTENCES for w in s.split()]
    assert values(fn.words(df, "value")) == sorted(expected)
    pairs = bag(fn.word_lengths(df, "value"))
    assert pairs[("Nebel", 5)] == 1 and pairs[("the", 3)] == 2 and pairs[(",", 1)] == 1 and sum(pairs.values()) == 13


def test_tokens_split_like_unicode_white_space(spark):
    odd = "a\tb\x0bc\x0cd\re\nf\x1cg\x1dh\x1ei\x1fj\x85k\xa0l m n o p q r s　t"
    texts = [odd, "  lead  and trail \n", "", " \t ", "é ü​x", "don't stop"]
    df = lines(spark, *texts, None).select("value", fn.tokens("value").alias("t"))
    found = {r.value: r.t for r in df.collect()}
    assert {t: t.split() for t in texts} == {t: found[t] for t in texts}
    assert found[None] is None


def test_a_text_has_words_if_it_has_tokens(spark):
    texts = ["", " ", "\x1c\x85\xa0\u2003\t\n", "\u3000x", "a", " b", "\u200b", None]
    df = lines(spark, *texts)
    assert df.where(fn.has_words("value").cast("int") != (F.size(fn.tokens("value")) > 0).cast("int")).count() == 0
    assert df.where(fn.has_words("value")).count() == 4


def test_every_single_character_separates_or_not_as_in_python(spark):
    points = [p for p in range(1, 0x3100) if not 0xD800 <= p <= 0xDFFF]
    df = spark.createDataFrame([(p, f"a{chr(p)}b") for p in points], "p int, value string")
    parted = {r.p for r in df.where(F.size(fn.tokens("value")) == 2).collect()}
    assert parted == {p for p in points if len(f"a{chr(p)}b".split()) == 2}


def test_split_keeps_empty_fields(spark):
    df = lines(spark, "a  b ", "x.y").select(
        fn.split_literal("value", " ").alias("s"), fn.split_literal("value", ".").alias("d")
    )
    assert [tuple(r) for r in df.collect()] == [(["a", "", "b", ""], ["a  b "]), (["x.y"], ["x", "y"])]


def test_short_lines_give_null(spark):
    df = fn.split_columns(lines(spark, "a b", "c"), "value", " ", ["first", "second", "third"])
    assert bag(df) == {("a", "b", None): 1, ("c", None, None): 1}
    assert values(lines(spark, "a b").select(F.isnull(fn.token("value", 5)))) == [True]


def test_explode_drops_empty_and_null_arrays(spark):
    df = spark.createDataFrame(
        [("oak", "bark leaf leaf"), ("moss", "\tspore"), ("rock", " "), ("fog", None)], "name string, c string"
    )
    assert bag(fn.words(df, "c", "part")) == {
        ("oak", "bark"): 1, ("oak", "leaf"): 2, ("moss", "spore"): 1,
    }


def test_json(spark):
    df = lines(spark, '{"buoy": {"id": 77, "bay": "Fundy"}, "more": 1}', "[1", "null")
    parsed = fn.parse_json(df, "value", "buoy struct<id: int, bay: string>").drop("value")
    flat = fn.flatten_struct(fn.flatten_struct(parsed, "parsed"), "buoy")
    assert flat.columns == ["id", "bay"]
    assert bag(flat) == {(77, "Fundy"): 1, (None, None): 2}


def test_minutes_between(spark):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ '2024-03-10 01:30:00' AS a, TIMESTAMP_NTZ '2024-03-10 03:30:00.9' AS b"
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert df.select(fn.minutes_between(df, "a", "b")).first()[0] == 120
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


APP_LOG = [
    "DEBUG: valve 3 opened", "ERROR: valve 3 stuck half open", "note without ERROR level word order",
    "WARN: pressure low", "ERROR:", "",
]
TIMED_LOG = [
    "2031-06-30 23:59:59 ERROR pump stalled, retry 1",
    "2031-07-01 00:00:00 INFO pump running",
    "2031-07-01 00:00:00 ERROR pump stalled, retry 2",
    "2031-07-02 04:10:00 TRACE",
]
WEB_LOG = [
    "10.9.8.7 PUT /tide 201 9ms", "10.9.8.7 GET /tide 200 4ms", "fe80::1 GET /moon 304 1ms",
    "fe80::1 GET /moon 200 2ms", "10.0.0.0 GET /stars 500 77ms", "10.0.0.0 GET /tide 200 3ms",
]


def test_application_logs(spark):
    assert bag(logs.error_words(lines(spark, *APP_LOG))) == {
        ("ERROR:",): 2, ("VALVE",): 1, ("3",): 1, ("STUCK",): 1, ("HALF",): 1, ("OPEN",): 1, ("NOTE",): 1,
        ("WITHOUT",): 1, ("ERROR",): 1, ("LEVEL",): 1, ("WORD",): 1, ("ORDER",): 1,
    }
    timed = lines(spark, *TIMED_LOG)
    assert [r.level for r in logs.log_levels(timed).collect()] == [
        "ERROR", "INFO", "ERROR", "TRACE",
    ]
    assert [r.message for r in logs.error_messages(timed).collect()] == [
        "pump stalled, retry 1", "pump stalled, retry 2",
    ]
    assert values(logs.error_messages(lines(spark, "ERROR", "d t ERROR"))) == ["", ""]


def test_web_log(spark):
    counts = logs.endpoint_counts(lines(spark, *WEB_LOG, "too short"))
    assert [tuple(r) for r in counts.collect()] == [("/tide", 2), ("/moon", 1)]


def test_access_log(spark):
    df = lines(
        spark,
        '1.1.1.1 - - [10/Oct:13 -0700] "GET /a HTTP/1.0" 200 23',
        '1.1.1.2 - - [10/Oct:13 -0700] "GET /a HTTP/1.0" 404 1',
        '1.1.1.1 - - [10/Oct:13 -0700] "GET /b HTTP/1.0" 200 9',
        "a b",
    )
    assert logs.access_log(df).columns == logs.ACCESS_FIELDS
    assert [tuple(r) for r in logs.log_counts(df, "IP_address").collect()] == [
        ("1.1.1.1", 2), ("1.1.1.2", 1), ("a", 1),
    ]
    assert bag(logs.log_counts(df, "endpoint")) == {("/a", 2): 1, ("/b", 1): 1, (None, 1): 1}
    assert bag(logs.log_counts(df, "status")) == {("200", 2): 1, ("404", 1): 1, (None, 1): 1}


def test_word_counts_are_sorted(spark):
    text = "salt sea salt\tgull sea wind salt  sea gull rope"
    assert [tuple(r) for r in logs.word_counts(lines(spark, text), "value").collect()] == [
        ("salt", 3), ("sea", 3), ("gull", 2), ("rope", 1), ("wind", 1),
    ]


@pytest.fixture
def hero_lines(spark):
    return lines(spark, "1 2 3 ", "2 1", "1 4", "3 1", "", "5 1 2 3 4")


def test_graph(spark, hero_lines):
    degree = graph.degrees(hero_lines)
    assert bag(degree) == {("1", 3): 1, ("2", 1): 1, ("3", 1): 1, ("5", 4): 1}
    names = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "id int, name string")
    assert bag(graph.most_connected(degree, names)) == {("5", 4, None): 1}
    assert bag(graph.least_connected(degree, names)) == {("2", 1, "B"): 1, ("3", 1, "C"): 1}


def test_words_end_at_every_kind_of_white_space(spark):
    """``WORD`` ends at the ranges that the SQL twins name, for every code point."""
    points = spark.range(1, 0x110000).where("id not between 55296 and 57343").select(F.col("id"), F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')").alias("c"))
    text = F.concat(F.lit("a"), "c", F.lit("b"))
    ranges = r"[^\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
    differing = points.where(~F.regexp_extract_all(text, F.lit(ranges), F.lit(0)).eqNullSafe(fn.tokens(text)))
    assert [hex(r.id) for r in differing.collect()] == []
    assert points.where(F.size(fn.tokens(text)) == 2).count() == 29
