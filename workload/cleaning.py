"""Cleaning rules. The tables are clean, so dirt is added by an expression first."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe.operators import clean
from loomframe.plans.etl import clean_people as clean_people_of
from workload.registry import Tables, query

BALANCE_GAPS_SQL = "CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END"


def _balance_gaps(t: Tables):
    known = F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal"))
    return t.customer.select("c_custkey", "c_mktsegment", known.alias("c_acctbal"))


@query("SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders")
def clean_dedupe(t: Tables):
    return clean.dedupe(t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority"))


@query("SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_custkey % 7 <> 0")
def clean_dropna(t: Tables):
    return clean.drop_nulls(_balance_gaps(t))


@query(
    f"""
    WITH gaps AS (SELECT c_custkey, c_mktsegment, {BALANCE_GAPS_SQL} AS c_acctbal FROM customer)
    SELECT c_custkey, c_mktsegment,
           round(coalesce(c_acctbal, (SELECT avg(c_acctbal) FROM gaps)), 4) AS c_acctbal
    FROM gaps
    """
)
def clean_fill_mean(t: Tables):
    filled = clean.fill_mean(_balance_gaps(t), "c_acctbal")
    return filled.withColumn("c_acctbal", F.round("c_acctbal", 4))


@query(
    f"""
    SELECT c_custkey, c_mktsegment, coalesce({BALANCE_GAPS_SQL}, 100) AS c_acctbal FROM customer
    """
)
def clean_fill_const(t: Tables):
    return clean.fill_const(_balance_gaps(t), {"c_acctbal": 100.0})


@query(
    rf"""
    WITH dirty AS (
        SELECT c_custkey,
            CASE WHEN c_custkey % 7 = 0 THEN 'nobody' ELSE 'c' || c_custkey || '@mail.test' END AS email,
            CASE c_custkey % 3 WHEN 0 THEN '(555) 123-4567' WHEN 1 THEN '+1 555.123.4567'
                ELSE '555-1234' END AS phone
        FROM customer
    )
    SELECT c_custkey,
        CASE WHEN regexp_matches(email, '{clean.EMAIL}') THEN email END AS email,
        CASE WHEN regexp_matches(phone,
            '{clean.PHONE}') THEN phone END AS phone
    FROM dirty
    """
)
def clean_validate(t: Tables):
    key = F.col("c_custkey")
    mail = F.concat(F.lit("c"), key.cast("string"), F.lit("@mail.test"))
    phone = (
        F.when(key % 3 == 0, "(555) 123-4567")
        .when(key % 3 == 1, "+1 555.123.4567")
        .otherwise("555-1234")
    )
    dirty = t.customer.select(
        "c_custkey",
        F.when(key % 7 == 0, "nobody").otherwise(mail).alias("email"),
        phone.alias("phone"),
    )
    return clean.validate(dirty, {"email": clean.EMAIL, "phone": clean.PHONE})


@query("SELECT c_custkey, regexp_replace(c_name, '[^a-zA-Z0-9\\s]', '', 'g') AS c_name FROM customer")
def clean_strip(t: Tables):
    return clean.strip_chars(t.customer.select("c_custkey", "c_name"), "c_name")


@query("SELECT p_partkey, upper(p_name) AS p_name FROM part")
def clean_upper(t: Tables):
    return clean.upper(t.part.select("p_partkey", "p_name"), "p_name")


@query(
    f"""
    SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal
    FROM (SELECT c_custkey, c_mktsegment, {BALANCE_GAPS_SQL} AS c_acctbal FROM customer)
    """
)
def clean_clamp(t: Tables):
    return clean.clamp_min(_balance_gaps(t), "c_acctbal", 0)


@query(
    f"""
    SELECT c_custkey, c_mktsegment, abs(c_acctbal) AS c_acctbal
    FROM (SELECT c_custkey, c_mktsegment, {BALANCE_GAPS_SQL} AS c_acctbal FROM customer)
    """
)
def clean_abs(t: Tables):
    return clean.fix_sign(_balance_gaps(t), ["c_acctbal"])


@query(
    """
    WITH people AS (
        SELECT DISTINCT CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS name,
            CASE WHEN c_custkey % 7 <> 0 THEN CAST(20 + c_custkey % 60 AS BIGINT) END AS age,
            c_mktsegment AS city
        FROM customer
    )
    SELECT coalesce(name, 'Unknown') AS name, city,
        round(coalesce(age, (SELECT avg(age) FROM people)), 6) AS age
    FROM people WHERE coalesce(age, (SELECT avg(age) FROM people)) > 30
    """
)
def clean_people(t: Tables):
    key = F.col("c_custkey")
    people = t.customer.select(
        F.when(key % 5 != 0, F.col("c_name")).alias("name"),
        F.when(key % 7 != 0, 20 + key % 60).alias("age"),
        F.col("c_mktsegment").alias("city"),
    )
    return clean_people_of(people).withColumn("age", F.round("age", 6))
