"""Join operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe.functions import exact_sum
from loomframe.operators import joins, windows
from workload.registry import Tables, query


@query(
    """
    SELECT c_custkey, c_name, o_orderkey, o_totalprice
    FROM customer JOIN orders ON c_custkey = o_custkey
    """
)
def join_inner(t: Tables):
    customer, orders = t.customer, t.orders
    joined = customer.join(orders, customer.c_custkey == orders.o_custkey).drop("o_custkey")
    return joined.select("c_custkey", "c_name", "o_orderkey", "o_totalprice")


@query(
    """
    SELECT o_custkey AS custkey, o_orderkey, c_mktsegment
    FROM orders JOIN customer ON o_custkey = c_custkey
    """
)
def join_using(t: Tables):
    orders = t.orders.select(F.col("o_custkey").alias("custkey"), "o_orderkey")
    customer = t.customer.select(F.col("c_custkey").alias("custkey"), "c_mktsegment")
    return orders.join(customer, on="custkey")


LARGE_F_SQL = "o_orderstatus = 'F' AND o_totalprice > 300000"


def _large_finished(t: Tables):
    return t.orders.where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 300000))


@query(
    f"""
    SELECT c_custkey, o_orderkey, o_totalprice FROM customer
    LEFT JOIN (SELECT * FROM orders WHERE {LARGE_F_SQL}) ON c_custkey = o_custkey
    """
)
def join_left(t: Tables):
    orders = _large_finished(t)
    joined = t.customer.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("c_custkey", "o_orderkey", "o_totalprice")


@query(
    f"""
    SELECT c_custkey, c_name FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE {LARGE_F_SQL})
    """
)
def join_anti(t: Tables):
    orders = _large_finished(t).withColumnRenamed("o_custkey", "c_custkey")
    return joins.without(t.customer, orders, "c_custkey").select("c_custkey", "c_name")


@query(
    """
    SELECT a.l_orderkey, a.l_partkey AS item1, b.l_partkey AS item2
    FROM lineitem a JOIN lineitem b
      ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey
    """
)
def join_self_pairs(t: Tables):
    return joins.pairs(t.lineitem, "l_orderkey", "l_partkey")


@query(
    """
    WITH sized AS (SELECT p_size, p_partkey, p_partkey % 7 AS grade FROM part)
    SELECT a.p_size, count(*) AS n, CAST(sum(a.p_partkey) AS BIGINT) AS lower_items,
        CAST(sum(a.grade * b.grade) AS BIGINT) AS products
    FROM sized a JOIN sized b ON a.p_size = b.p_size AND a.p_partkey < b.p_partkey
    GROUP BY 1
    """
)
def join_pairs_split(t: Tables):
    # Of all pairs only sums are asked for, so none is formed: keys are cut into slices, not into cells.
    grade = F.col("p_partkey") % 7
    one = F.lit(1)
    sums = {"n": (one, one), "lower_items": (F.col("p_partkey"), one), "products": (grade, grade)}
    return windows.pair_sums(t.part, "p_size", "p_partkey", sums, share=0.01, min_rows=10)


@query(
    """
    SELECT c_name, o_orderkey, l_linenumber, p_name
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
    """
)
def join_three_way(t: Tables):
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .select("c_name", "o_orderkey", "l_linenumber", "p_name")
    )


@query(
    """
    SELECT c_custkey, c_name, round(sum(o_totalprice), 2) AS total, count(*) AS n_orders
    FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name
    """
)
def join_preaggregated(t: Tables):
    aggs = [exact_sum("o_totalprice").alias("total"), F.count("*").alias("n_orders")]
    customer = t.customer.select("c_custkey", "c_name")
    return joins.agg_then_join(customer, t.orders, "c_custkey", "o_custkey", aggs)


@query(
    """
    SELECT c_mktsegment, round(sum(o_totalprice), 2) AS total, count(*) AS n_orders
    FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_mktsegment
    """
)
def join_then_agg(t: Tables):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(
        exact_sum("o_totalprice").alias("total"), F.count("*").alias("n_orders")
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, p_name, s_name
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_size > 10
    LEFT JOIN supplier ON l_suppkey = s_suppkey
    """
)
def join_broadcast_lookup(t: Tables):
    part = t.part.where(F.col("p_size") > 10).select(F.col("p_partkey").alias("l_partkey"), "p_name")
    supplier = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    named = joins.lookup(joins.lookup(t.lineitem, part, "l_partkey"), supplier, "l_suppkey")
    return named.select("l_orderkey", "l_linenumber", "p_name", "s_name")


@query(
    """
    SELECT l.key, l_linenumber, l_partkey, o_custkey
    FROM (SELECT CASE WHEN l_linenumber <= 2 THEN 0 ELSE l_orderkey END AS key, * FROM lineitem) l
    JOIN orders ON l.key = o_orderkey
    """
)
def join_salted(t: Tables):
    # Two of every seven lines are given to order 0, which makes it a hot key.
    hot = F.when(F.col("l_linenumber") <= 2, F.lit(0)).otherwise(F.col("l_orderkey"))
    lines = t.lineitem.select(hot.cast("long").alias("key"), "l_linenumber", "l_partkey")
    orders = t.orders.select(F.col("o_orderkey").alias("key"), "o_custkey")
    return joins.salted_join(lines, orders, ["key"], salts=16, min_rows=1000)


HOT_SUPPLIER_SQL = "CASE WHEN l_linenumber <= 2 THEN 0 ELSE l_suppkey END"


def _lines_of_hot_supplier(t: Tables):
    key = F.when(F.col("l_linenumber") <= 2, F.lit(0)).otherwise(F.col("l_suppkey"))
    return t.lineitem.select(key.cast("long").alias("s_suppkey"), "l_orderkey", "l_linenumber")


@query(
    f"""
    SELECT s_suppkey, l_orderkey, l_linenumber FROM (SELECT {HOT_SUPPLIER_SQL} AS s_suppkey, * FROM lineitem) l
    WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.s_suppkey AND s_acctbal > 0)
    """
)
def join_anti_hot(t: Tables):
    # Nearly a third of the left rows have one key, which is not on the right.
    return joins.without(_lines_of_hot_supplier(t), t.supplier.where("s_acctbal > 0"), "s_suppkey")


@query(
    """
    SELECT l_orderkey, l_linenumber, o_custkey, o_orderpriority FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE o_totalprice > 300000
    """
)
def join_filtered(t: Tables):
    orders = t.orders.where("o_totalprice > 300000").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority")
    return joins.reduced_join(t.lineitem.select("l_orderkey", "l_linenumber"), orders, "l_orderkey")


@query(
    f"""
    SELECT s_suppkey, l_orderkey, l_linenumber FROM (SELECT {HOT_SUPPLIER_SQL} AS s_suppkey, * FROM lineitem) l
    WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.s_suppkey AND s_acctbal < 0)
    """
)
def join_anti_filtered(t: Tables):
    poor = t.supplier.where("s_acctbal < 0").select("s_suppkey")
    return joins.reduced_join(_lines_of_hot_supplier(t), poor, "s_suppkey", "left_anti")
