"""Column expressions and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe.functions import flatten_struct, grep, parse_json
from loomframe.functions import split_columns as split_into
from loomframe.operators import clean
from loomframe.plans.sales import line_revenue as revenue_of
from workload.registry import Tables, day_text, query


@query("SELECT c_name, c_mktsegment FROM customer")
def proj_select(t: Tables):
    return t.customer.select("c_name", "c_mktsegment")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net, l_quantity * 2 AS l_quantity
    FROM lineitem
    """
)
def proj_derive(t: Tables):
    return (
        t.lineitem.withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
        .withColumn("l_quantity", F.col("l_quantity") * 2)
        .select("l_orderkey", "l_linenumber", "net", "l_quantity")
    )


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def proj_drop(t: Tables):
    return t.supplier.drop("s_nationkey", "no_such_column")


@query("SELECT l_orderkey, l_linenumber, round(l_extendedprice * l_quantity, 2) AS revenue FROM lineitem")
def line_revenue(t: Tables):
    return revenue_of(t.lineitem, ["l_orderkey", "l_linenumber"], "l_extendedprice", "l_quantity")


@query("SELECT p_partkey, p_size * p_size AS squared FROM part")
def map_square(t: Tables):
    return t.part.select("p_partkey", (F.col("p_size") * F.col("p_size")).alias("squared"))


@query("SELECT 'num_' || p_partkey AS label FROM part")
def map_prefix(t: Tables):
    return t.part.select(F.concat(F.lit("num_"), F.col("p_partkey").cast("string")).alias("label"))


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 5000")
def filter_gt(t: Tables):
    return t.customer.where(F.col("c_acctbal") > 5000).select("c_custkey", "c_acctbal")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 2 = 0")
def filter_even(t: Tables):
    return t.orders.where(F.col("o_orderkey") % 2 == 0).select("o_orderkey", "o_custkey")


@query(
    """
    SELECT o_orderkey FROM orders
    WHERE (o_orderstatus = 'F' OR o_orderstatus = 'P') AND o_totalprice > 200000 AND o_custkey > 50
    """
)
def filter_bool(t: Tables):
    status = (F.col("o_orderstatus") == "F") | (F.col("o_orderstatus") == "P")
    large = (F.col("o_totalprice") > 200000) & (F.col("o_custkey") > 50)
    return t.orders.where(status & large).select("o_orderkey")


@query("SELECT doc_id, n_chars FROM documents WHERE contains(text, 'th')")
def filter_contains(t: Tables):
    return grep(t.documents, "text", "th").select("doc_id", "n_chars")


NULL_DATE_SQL = "CASE WHEN o_orderkey % 11 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END"


@query(
    f"""
    SELECT o_orderkey, placed FROM (SELECT o_orderkey, {NULL_DATE_SQL} AS placed FROM orders)
    WHERE placed IS NOT NULL
    """
)
def filter_not_null(t: Tables):
    day = F.when(F.col("o_orderkey") % 11 != 0, day_text("o_orderdate"))
    dated = t.orders.withColumn("placed", day)
    return dated.where(F.col("placed").isNotNull()).select("o_orderkey", "placed")


@query("SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^(red|blue)\\s\\w+t$')")
def filter_regex(t: Tables):
    return t.part.where(F.col("p_name").rlike(r"^(red|blue)\s\w+t$")).select("p_partkey", "p_name")


@query("SELECT p_partkey, p_size FROM part WHERE p_size = (SELECT min(p_size) FROM part)")
def filter_eq_min(t: Tables):
    smallest = t.part.agg(F.min("p_size")).scalar()
    return t.part.where(F.col("p_size") == smallest).select("p_partkey", "p_size")


@query(
    """
    SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 'high' WHEN o_totalprice > 100000 THEN 'mid'
                            ELSE 'low' END AS band,
           CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END AS finished
    FROM orders
    """
)
def case_when(t: Tables):
    price = F.col("o_totalprice")
    band = F.when(price > 250000, "high").when(price > 100000, "mid").otherwise("low")
    finished = F.when(F.col("o_orderstatus") == "F", price).otherwise(0)
    return t.orders.select("o_orderkey", band.alias("band"), finished.alias("finished"))


@query(
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS id, event_type AS city FROM events
    """
)
def json_flatten(t: Tables):
    # A customer struct inside the JSON, taken apart in two steps.
    text = F.concat(
        F.lit('{"customer": {"id": '),
        F.get_json_object("props", "$.k"),
        F.lit(', "city": "'),
        "event_type",
        F.lit('"}}'),
    )
    nested = t.events.select("event_id", text.alias("json"))
    parsed = parse_json(nested, "json", "customer struct<id: int, city: string>").drop("json")
    return flatten_struct(flatten_struct(parsed, "parsed"), "customer")


@query(
    """
    SELECT event_id, split_part(v, ' ', 1) AS actor, split_part(v, ' ', 2) AS verb,
           CASE WHEN event_id % 4 <> 0 THEN split_part(v, ' ', 3) END AS k
    FROM (SELECT event_id, user_id || ' ' || event_type || ' ' || replace(props, ' ', '_') AS v
          FROM events)
    """
)
def split_columns(t: Tables):
    full = F.concat_ws(" ", "user_id", "event_type", F.regexp_replace("props", " ", "_"))
    short = F.concat_ws(" ", "user_id", "event_type")
    line = F.when(F.col("event_id") % 4 != 0, full).otherwise(short)
    lines = t.events.select("event_id", line.alias("value"))
    return split_into(lines, "value", " ", ["actor", "verb", "k"])


@query("SELECT c_custkey, c_name, 'x ' || c_mktsegment AS c_mktsegment FROM customer")
def clean_trim(t: Tables):
    padded = t.customer.select(
        "c_custkey",
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"),
        F.concat(F.lit(" x "), "c_mktsegment").alias("c_mktsegment"),
    )
    return clean.trim_strings(padded)
