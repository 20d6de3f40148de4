"""Sorting and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe.operators import ordering
from workload.registry import Tables, query


@query("SELECT o_orderkey, o_totalprice FROM orders")
def sort_desc(t: Tables):
    orders = t.orders.select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), F.asc("o_orderkey"))


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
    ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 25
    """
)
def topk(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    order = [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey"]
    return ordering.top_k(lines, order, 25)


@query("SELECT l_quantity FROM lineitem ORDER BY l_quantity DESC LIMIT 30")
def top_n_values(t: Tables):
    return ordering.largest(t.lineitem, "l_quantity", 30)


@query("SELECT c_acctbal FROM customer ORDER BY c_acctbal LIMIT 30")
def bottom_n_values(t: Tables):
    return ordering.smallest(t.customer, "c_acctbal", 30)


@query("SELECT p_partkey, p_size FROM part ORDER BY p_size DESC, p_partkey LIMIT 1")
def argmax(t: Tables):
    return ordering.argmax(t.part.select("p_partkey", "p_size"), "p_size", "p_partkey")


@query(
    """
    WITH n AS (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1)
    SELECT * FROM n WHERE n_orders = (SELECT min(n_orders) FROM n)
    """
)
def argmin_ties(t: Tables):
    per_customer = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n_orders"))
    return ordering.argmin_all(per_customer, "n_orders")


@query("SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys FROM (SELECT * FROM orders LIMIT 100)")
def limit_n(t: Tables):
    # Which rows come is open, so the query reports how many there are.
    return t.orders.limit(100).agg(
        F.count("*").alias("n_rows"), F.countDistinct("o_orderkey").alias("n_keys")
    )


@query(
    """
    SELECT 'first' AS action, * FROM (SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1)
    UNION ALL SELECT 'take', * FROM (SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 3)
    UNION ALL SELECT 'tail', * FROM (SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey DESC LIMIT 2)
    """
)
def fetch_actions(t: Tables):
    # What the actions bring to the driver: a few rows each.
    orders = t.orders.select("o_orderkey", "o_totalprice")
    ordered = orders.orderBy(F.desc("o_totalprice"), F.asc("o_orderkey"))
    first = ordered.first()
    found = [("first", *r) for r in ([] if first is None else [first])]
    found += [("take", *r) for r in ordered.take(3)] + [("tail", *r) for r in ordered.tail(2)]
    return t.spark.createDataFrame(found, "action string, o_orderkey long, o_totalprice double")
