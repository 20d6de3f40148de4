"""Writers and catalog tables, each read back through Spark."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from loomframe import sinks, sources
from workload.registry import Tables, query


def _table_name(base: str) -> str:
    return f"{base}_{uuid.uuid4().hex[:12]}"


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 300000")
def sink_parquet(t: Tables):
    path = sinks.scratch_dir(t.spark, "orders-parquet")
    sinks.write_parquet(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), path)
    return t.spark.read.parquet(path).where(F.col("o_totalprice") > 300000)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def sink_csv(t: Tables):
    path = sinks.scratch_dir(t.spark, "customer-csv")
    sinks.write_csv(t.customer.select("c_custkey", "c_name", "c_acctbal"), path)
    schema = "c_custkey bigint, c_name string, c_acctbal double"
    return sources.read_csv(t.spark, path, schema)


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment = 'MACHINERY'")
def sink_partitioned(t: Tables):
    path = sinks.scratch_dir(t.spark, "customer-by-segment")
    customer = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    sinks.write_partitioned(customer, path, "c_mktsegment")
    return t.spark.read.parquet(path).where(F.col("c_mktsegment") == "MACHINERY")


@query("SELECT s_suppkey, s_acctbal + 2 AS s_acctbal FROM supplier")
def sink_table(t: Tables):
    # The second replacement reads the table that it replaces.
    name = _table_name("balances")
    for step in (1, 2):
        rows = t.supplier.select("s_suppkey", "s_acctbal") if step == 1 else t.spark.table(name)
        plus_one = rows.withColumn("s_acctbal", F.col("s_acctbal") + 1)
        sinks.replace_table(plus_one, name, path=sinks.scratch_dir(t.spark, name))
    return t.spark.table(name)


@query("SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys FROM orders")
def ext_table(t: Tables):
    path, name = sinks.scratch_dir(t.spark, "orders-ext"), _table_name("orders_ext")
    sinks.write_parquet(t.orders.select("o_orderkey", "o_orderstatus"), path)
    sinks.register_external(t.spark, name, path)
    return t.spark.table(name).agg(
        F.count("*").alias("n_rows"), F.countDistinct("o_orderkey").alias("n_keys")
    )


@query(
    """
    SELECT * FROM (VALUES ('p_partkey', 'bigint'), ('p_name', 'string'), ('p_brand', 'string'),
        ('p_type', 'string'), ('p_size', 'int'), ('p_retailprice', 'double'))
        AS columns (col_name, data_type)
    """
)
def describe_table(t: Tables):
    # The schema is that of the given files, which are registered as they lie.
    name = _table_name("part_described")
    sinks.register_external(t.spark, name, f"{t.sf_dir}/part.parquet")
    return sinks.describe(t.spark, name)


@query("SELECT 1 AS databases, 1 AS tables, count(*) AS n_rows, CAST(sum(r_regionkey) AS BIGINT) AS keys FROM region")
def table_lifecycle(t: Tables):
    # A database with an empty typed table, filled from the given rows, read, and dropped with all in it.
    db, path = _table_name("geo"), sinks.scratch_dir(t.spark, "geo")
    sinks.ensure_database(t.spark, db)
    sinks.create_table(t.spark, f"{db}.regions", "r_regionkey int, r_name string")
    t.region.select(F.col("r_regionkey").cast("int"), "r_name").write.insertInto(f"{db}.regions")
    named = t.spark.sql(f"SHOW DATABASES LIKE '{db}'").agg(F.count("*").cast("int").alias("databases"))
    tables = sinks.list_tables(t.spark, db).agg(F.count("*").cast("int").alias("tables"))
    rows = t.spark.table(f"{db}.regions").agg(F.count("*").alias("n_rows"), F.sum("r_regionkey").alias("keys"))
    report = named.select("databases", tables.scalar().alias("tables"), F.lit(1).alias("one"))
    sinks.write_parquet(report.join(rows.withColumn("one", F.lit(1)), "one").drop("one"), path)
    sinks.drop_table(t.spark, f"{db}.regions")
    sinks.drop_database(t.spark, db)
    return t.spark.read.parquet(path)


@query("SELECT least(count(*), 7) AS n_rows, least(count(*), 7) AS known FROM nation")
def table_preview(t: Tables):
    # Which rows come first is open; each has to be one of the table.
    name = _table_name("nation_preview")
    sinks.register_external(t.spark, name, f"{t.sf_dir}/nation.parquet")
    few = sinks.preview(t.spark, name, 7)
    known = t.nation.select("n_nationkey", F.lit(1).alias("known"))
    return few.join(known, "n_nationkey", "left").agg(F.count("*").alias("n_rows"), F.count("known").alias("known"))


@query("SELECT count(*) AS n_rows FROM lineitem")
def count_rows(t: Tables):
    return sinks.count_rows(t.lineitem)


@query(
    """
    SELECT o_orderkey, o_custkey, count(*) AS n_lines, CAST(sum(l_linenumber) AS BIGINT) AS lines
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2
    """
)
def sink_bucketed(t: Tables):
    # Both tables in equal buckets: the join and the grouping need no shuffle.
    orders, lines = _table_name("orders_bucketed"), _table_name("lines_bucketed")
    sinks.write_bucketed(t.orders.select("o_orderkey", "o_custkey"), orders, "o_orderkey", 8)
    sinks.write_bucketed(t.lineitem.select("l_orderkey", "l_linenumber"), lines, "l_orderkey", 8)
    joined = t.spark.table(orders).join(t.spark.table(lines).hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderkey", "o_custkey").agg(F.count("*").alias("n_lines"), F.sum("l_linenumber").alias("lines"))


@query(
    """
    SELECT c_custkey, c_mktsegment, CAST(floor(c_acctbal) AS BIGINT) + CASE c_mktsegment WHEN 'MACHINERY' THEN 5 ELSE 0 END AS points
    FROM customer
    """
)
def sink_replace_partitions(t: Tables):
    # All segments once, then one of them anew, by a run that is repeated.
    path = sinks.scratch_dir(t.spark, "points")
    points = t.customer.select("c_custkey", "c_mktsegment", F.floor("c_acctbal").alias("points"))
    sinks.replace_partitions(points, path, "c_mktsegment")
    for _ in range(2):
        machinery = points.where("c_mktsegment = 'MACHINERY'").withColumn("points", F.col("points") + 5)
        sinks.replace_partitions(machinery, path, "c_mktsegment")
    return t.spark.read.parquet(path)
