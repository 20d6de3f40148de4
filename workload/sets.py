"""Set operations, on columns with NULLs and repeats."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe.operators import sets
from workload.registry import Tables, query

# Customer numbers per nation, NULL for nation 3: repeats and NULLs on both sides.
LEFT_SQL = "SELECT CASE WHEN c_nationkey <> 3 THEN c_nationkey END AS k, c_mktsegment AS s FROM customer"
RIGHT_SQL = "SELECT CASE WHEN s_nationkey <> 3 THEN s_nationkey END AS k, 'BUILDING' AS s FROM supplier"


def _left(t: Tables):
    nation = F.when(F.col("c_nationkey") != 3, F.col("c_nationkey"))
    return t.customer.select(nation.alias("k"), F.col("c_mktsegment").alias("s"))


def _right(t: Tables):
    nation = F.when(F.col("s_nationkey") != 3, F.col("s_nationkey"))
    return t.supplier.select(nation.alias("k"), F.lit("BUILDING").alias("s"))


@query(f"{LEFT_SQL} UNION ALL {RIGHT_SQL}")
def set_union_all(t: Tables):
    return sets.union_all(_left(t), _right(t))


@query(f"{LEFT_SQL} INTERSECT {RIGHT_SQL}")
def set_intersect(t: Tables):
    return sets.intersect(_left(t), _right(t))


@query(
    f"""
    SELECT k, s FROM ({LEFT_SQL}) a WHERE NOT EXISTS (
        SELECT 1 FROM ({RIGHT_SQL}) b
        WHERE a.k IS NOT DISTINCT FROM b.k AND a.s IS NOT DISTINCT FROM b.s)
    """
)
def set_subtract(t: Tables):
    return sets.subtract(_left(t), _right(t))
