"""Text, array, JSON, numeric and time functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe.functions import (
    minutes_between,
    parse_json,
    rest_of_line,
    split_literal,
    token,
    tokens,
    word_lengths,
    words,
)
from workload.aggregates import WHITESPACE_SQL, WORDS_SQL
from workload.registry import Tables, query

TOKENS_SQL = f"[x FOR x IN string_split_regex(text, '{WHITESPACE_SQL}') IF x <> '']"


def _documents(t: Tables):
    return t.documents


@query(
    """
    SELECT doc_id, array_to_string(string_split(text, ' '), '|') AS parts,
        CAST(len(string_split(text, ' ')) AS INTEGER) AS n
    FROM documents
    """
)
def fn_split(t: Tables):
    parts = split_literal("text", " ")
    return _documents(t).select(
        "doc_id", F.array_join(parts, "|").alias("parts"), F.size(parts).alias("n")
    )


@query(f"SELECT doc_id, array_to_string({TOKENS_SQL}, '|') AS tokens FROM documents")
def fn_tokenize(t: Tables):
    return _documents(t).select("doc_id", F.array_join(tokens("text"), "|").alias("tokens"))


@query(f"SELECT doc_id, CAST(len({TOKENS_SQL}) - 1 AS INTEGER) AS others FROM documents")
def fn_array_size(t: Tables):
    return _documents(t).select("doc_id", (F.size(tokens("text")) - 1).alias("others"))


@query(f"SELECT doc_id, ({TOKENS_SQL})[1] AS first, ({TOKENS_SQL})[40] AS fortieth FROM documents")
def fn_element(t: Tables):
    return _documents(t).select(
        "doc_id", token("text", 0).alias("first"), token("text", 39).alias("fortieth")
    )


@query(f"SELECT doc_id, array_to_string(({TOKENS_SQL})[4:], ' ') AS message FROM documents")
def fn_slice_join(t: Tables):
    return _documents(t).select("doc_id", rest_of_line("text", 3).alias("message"))


@query(
    """
    SELECT p_partkey, unnest(string_split(p_name, ' ')) AS part FROM part WHERE p_partkey % 5 <> 0
    """
)
def fn_explode(t: Tables):
    # Every fifth array is NULL and leaves no row.
    names = F.when(F.col("p_partkey") % 5 != 0, split_literal("p_name", " "))
    return t.part.select("p_partkey", F.explode(names).alias("part"))


@query(WORDS_SQL)
def fn_words(t: Tables):
    return words(_documents(t).select("text"), "text")


@query(f"SELECT word, CAST(length(word) AS INTEGER) AS length FROM ({WORDS_SQL})")
def fn_word_length(t: Tables):
    return word_lengths(_documents(t), "text")


@query(
    """
    SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k
    FROM events
    """
)
def json_parse(t: Tables):
    # Every ninth text has lost its last character and is no JSON any more.
    broken = F.expr("left(props, length(props) - 1)")
    text = F.when(F.col("event_id") % 9 != 0, F.col("props")).otherwise(broken)
    parsed = parse_json(t.events.select("event_id", text.alias("props")), "props", "k int")
    return parsed.select("event_id", F.col("parsed.k").alias("k"))


@query(
    """
    SELECT c_custkey, round(abs(c_acctbal), 6) AS magnitude, round(sqrt(abs(c_acctbal)), 6) AS root,
        round(c_acctbal * c_acctbal, 6) AS squared, c_custkey % 7 AS rest,
        round((c_acctbal + 1) / (c_custkey + 1) - 2, 6) AS mixed
    FROM customer
    """
)
def fn_math(t: Tables):
    balance, key = F.col("c_acctbal"), F.col("c_custkey")
    return t.customer.select(
        "c_custkey",
        F.round(F.abs(balance), 6).alias("magnitude"),
        F.round(F.sqrt(F.abs(balance)), 6).alias("root"),
        F.round(F.pow(balance, 2), 6).alias("squared"),
        (key % 7).alias("rest"),
        F.round((balance + 1) / (key + 1) - 2, 6).alias("mixed"),
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
        (epoch(l_shipdate) - epoch(o_orderdate)) / 60 AS minutes
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """
)
def fn_minutes_between(t: Tables):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    minutes = minutes_between(joined, "o_orderdate", "l_shipdate").alias("minutes")
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", minutes)


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS price,
        CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS priority
    FROM orders
    """
)
def fn_cast(t: Tables):
    text = F.col("o_totalprice").cast("string")
    dirty = F.when(F.col("o_orderkey") % 4 != 0, text).otherwise("n/a")
    priority = F.get(split_literal("o_orderpriority", "-"), F.lit(0))
    return t.orders.select(
        "o_orderkey", dirty.try_cast("double").alias("price"), priority.cast("int").alias("priority")
    )


@query(
    """
    SELECT n_nationkey, 'nation' AS kind, CAST(7 AS INTEGER) AS whole, 0.5::DOUBLE AS half, true AS yes, CAST(NULL AS VARCHAR) AS nothing
    FROM nation
    """
)
def fn_literals(t: Tables):
    return t.nation.select(
        "n_nationkey", F.lit("nation").alias("kind"), F.lit(7).alias("whole"), F.lit(0.5).alias("half"), F.lit(True).alias("yes"),
        F.lit(None).cast("string").alias("nothing"),
    )
