"""Partition and key distribution."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe.operators import aggs, layout
from workload.registry import Tables, query


@query("SELECT CAST(16 AS BIGINT) AS partitions, count(*) AS n_rows FROM orders")
def partition_profile(t: Tables):
    profile = layout.partition_profile(t.orders.select("o_orderkey").repartition(16))
    return profile.agg(
        F.count("*").alias("partitions"), F.sum("n_rows").alias("n_rows")
    )


HOT_KEY_SQL = "CASE WHEN l_linenumber <= 2 THEN 0 ELSE l_suppkey END"


def _hot(t: Tables):
    key = F.when(F.col("l_linenumber") <= 2, F.lit(0)).otherwise(F.col("l_suppkey"))
    return t.lineitem.select(key.cast("long").alias("key"), "l_partkey")


@query(
    f"""
    SELECT {HOT_KEY_SQL} AS key, count(*) AS n_rows,
        round(count(*) / (SELECT count(*) FROM lineitem), 9) AS share
    FROM lineitem GROUP BY 1 ORDER BY n_rows DESC, key LIMIT 10
    """
)
def key_skew(t: Tables):
    return layout.key_skew(_hot(t), ["key"]).withColumn("share", F.round("share", 9))


@query(
    f"""
    SELECT {HOT_KEY_SQL} AS key, CAST(sum(l_partkey) AS BIGINT) AS total, count(l_partkey) AS n
    FROM lineitem GROUP BY 1
    """
)
def agg_salted(t: Tables):
    return aggs.salted_agg(_hot(t), "key", "l_partkey", salts=16)


@query("SELECT count(DISTINCT o_custkey) AS n_keys, CAST(0 AS BIGINT) AS n_parted FROM orders")
def repartition_by_key(t: Tables):
    # All rows of a key are in one partition.
    placed = t.orders.select("o_custkey").repartition(16, "o_custkey").withColumn("partition", F.spark_partition_id())
    keys = placed.groupBy("o_custkey").agg(F.min("partition").alias("low"), F.max("partition").alias("high"))
    return keys.agg(F.count("*").alias("n_keys"), F.count_if(F.col("low") < F.col("high")).alias("n_parted"))


@query("SELECT 16 AS before, 5 AS after, count(*) AS n_rows FROM orders")
def coalesce_partitions(t: Tables):
    # Fewer partitions without a shuffle; the number of partitions is the largest one seen, from 0 on.
    spread = t.orders.select("o_orderkey").repartition(16).withColumn("before", F.spark_partition_id())
    fewer = spread.coalesce(5).withColumn("after", F.spark_partition_id())
    return fewer.agg((F.max("before") + 1).alias("before"), (F.max("after") + 1).alias("after"), F.count("*").alias("n_rows"))
