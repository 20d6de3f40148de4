"""Aggregation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe.operators import aggs
from loomframe.plans.logs import word_counts as count_words
from loomframe.plans.similarity import item_similarity as similarity_of
from workload.registry import Tables, day_text, query

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

RATINGS_SQL = """
    ratings AS (
        SELECT o_custkey AS usr, l_suppkey AS item, CAST(max(ceil(l_quantity / 10)) AS INTEGER) AS rating
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2
    )
"""
SIMS_SQL = f"""
    {RATINGS_SQL},
    sims AS (
        SELECT a.item AS item1, b.item AS item2, count(*) AS num_pairs,
            sum(a.rating * b.rating) / (sqrt(sum(a.rating * a.rating)) * sqrt(sum(b.rating * b.rating))) AS score
        FROM ratings a JOIN ratings b ON a.usr = b.usr AND a.item < b.item GROUP BY 1, 2
    )
"""


def ratings(t: Tables):
    """One rating from 1 to 5 per customer and supplier, from the ordered quantities."""
    lines = t.lineitem
    lines = lines.select("l_orderkey", "l_suppkey", "l_quantity")
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    stars = F.ceil(F.col("l_quantity") / 10).cast("int")
    return (
        lines.join(orders, "l_orderkey")
        .groupBy(F.col("o_custkey").alias("usr"), F.col("l_suppkey").alias("item"))
        .agg(F.max(stars).alias("rating"))
    )


@query("SELECT l_suppkey, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1")
def agg_sum_by(t: Tables):
    return aggs.total_by(t.lineitem, "l_suppkey", "l_extendedprice", digits=2)


@query("SELECT l_partkey, round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY 1")
def agg_avg_by(t: Tables):
    means = aggs.mean_by(t.lineitem, "l_partkey", "l_quantity", digits=0)
    return means.withColumn("mean", F.round("mean", 6))


@query(
    """
    SELECT o_orderpriority, count(CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey END) AS n
    FROM orders GROUP BY 1
    """
)
def agg_count_col(t: Tables):
    known = F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderkey"))
    return aggs.count_by(t.orders.withColumn("known", known), "o_orderpriority", "known")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def agg_count_star(t: Tables):
    return aggs.count_by(t.events, "event_type")


@query("SELECT round(avg(c_acctbal), 6) AS mean FROM customer")
def agg_global_avg(t: Tables):
    return t.customer.agg(F.round(F.avg("c_acctbal"), 6).alias("mean"))


@query("SELECT min(p_retailprice) AS cheapest FROM part")
def agg_global_min(t: Tables):
    return t.part.agg(F.min("p_retailprice").alias("cheapest"))


@query(
    """
    SELECT CAST(sum(l_partkey) AS BIGINT) AS total, max(l_partkey) AS largest, min(l_partkey) AS smallest
    FROM lineitem
    """
)
def agg_reduce(t: Tables):
    return aggs.summarize(t.lineitem, "l_partkey")


@query(
    """
    SELECT 'all' AS rows_used, CAST(sum(l_linenumber) AS BIGINT) AS total FROM lineitem
    UNION ALL
    SELECT 'none', CAST(coalesce(sum(l_linenumber), 0) AS BIGINT) FROM lineitem WHERE l_linenumber < 0
    """
)
def agg_fold(t: Tables):
    full = aggs.fold_sum(t.lineitem, "l_linenumber")
    empty = aggs.fold_sum(t.lineitem.where(F.col("l_linenumber") < 0), "l_linenumber")
    return full.select(F.lit("all").alias("rows_used"), "total").unionAll(
        empty.select(F.lit("none").alias("rows_used"), "total")
    )


@query("SELECT p_brand, count(*) AS n FROM part GROUP BY 1")
def agg_value_counts(t: Tables):
    return aggs.value_counts(t.part, "p_brand")


WHITESPACE_SQL = (
    r"[\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
WORDS_SQL = f"""
    SELECT word FROM (SELECT unnest(string_split_regex(text, '{WHITESPACE_SQL}')) AS word FROM documents)
    WHERE word <> ''
"""


@query(f"SELECT word, count(*) AS n FROM ({WORDS_SQL}) GROUP BY 1")
def word_counts(t: Tables):
    return count_words(t.documents, "text")


@query(
    """
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
    """
)
def agg_having_dups(t: Tables):
    return aggs.find_duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(f"WITH {SIMS_SQL} SELECT item1, item2, round(score, 9) AS score, num_pairs FROM sims")
def item_similarity(t: Tables):
    sims = similarity_of(ratings(t), "usr", "item", "rating")
    return sims.withColumn("score", F.round("score", 9))


@query(
    """
    WITH ratings AS (
        SELECT o_custkey AS usr, l_suppkey AS item, CAST(ceil(l_quantity / 10) AS INTEGER) AS rating
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    )
    SELECT a.item AS item1, b.item AS item2, count(*) AS num_pairs, round(sum(a.rating * b.rating)
        / (sqrt(sum(a.rating * a.rating)) * sqrt(sum(b.rating * b.rating))), 9) AS score
    FROM ratings a JOIN ratings b ON a.usr = b.usr AND a.item < b.item GROUP BY 1, 2 HAVING count(*) >= 12
    """
)
def item_similarity_min(t: Tables):
    # A customer rates a supplier once for each order line, so ratings repeat.
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("usr"))
    stars = F.ceil(F.col("l_quantity") / 10).cast("int").alias("rating")
    rated = t.lineitem.join(orders, "l_orderkey").select("usr", F.col("l_suppkey").alias("item"), stars)
    sims = similarity_of(rated, "usr", "item", "rating", min_pairs=12)
    return sims.withColumn("score", F.round("score", 9))


@query(
    "SELECT strftime(ts, '%Y-%m-%d') AS day, "
    + ", ".join(
        f"CAST(sum(CAST(floor(value) AS BIGINT)) FILTER (event_type = '{e}') AS BIGINT) AS {e}"
        for e in EVENT_TYPES
    )
    + " FROM events GROUP BY 1"
)
def agg_pivot(t: Tables):
    day = day_text("ts").alias("day")
    events = t.events.select(day, "event_type", F.floor("value").alias("whole"))
    return aggs.pivot_sum(events, "day", "event_type", "whole", EVENT_TYPES)


@query("SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def agg_distinct(t: Tables):
    return t.lineitem.select("l_suppkey", "l_returnflag").distinct()


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
MAP_TEXT = "array_join(transform(map_entries(by_value), e -> concat(e.key, '=', e.value)), ';')"


@query(
    """
    SELECT c_nationkey, string_agg(c_mktsegment || '=' || n, ';' ORDER BY c_mktsegment) AS sums
    FROM (SELECT c_nationkey, c_mktsegment, CAST(sum(c_custkey) AS BIGINT) AS n FROM customer GROUP BY 1, 2)
    GROUP BY 1
    """
)
def agg_pivot_map(t: Tables):
    # A limit below the number of segments, so that the sums come as a map.
    found = aggs.pivot_or_map(t.customer, "c_nationkey", "c_mktsegment", "c_custkey", limit=3)
    return found.select("c_nationkey", F.expr(MAP_TEXT).alias("sums"))


@query(
    "SELECT c_nationkey, "
    + ", ".join(f"CAST(sum(c_custkey) FILTER (c_mktsegment = '{s}') AS BIGINT) AS \"{s}\"" for s in SEGMENTS)
    + " FROM customer GROUP BY 1"
)
def agg_pivot_found(t: Tables):
    # Without given values: a first query finds them. Segments that a scale lacks are added as empty columns.
    found = aggs.pivot_or_map(t.customer, "c_nationkey", "c_mktsegment", "c_custkey", limit=100)
    return found.select("c_nationkey", *[F.col(s) if s in found.columns else F.lit(None).cast("long").alias(s) for s in SEGMENTS])
