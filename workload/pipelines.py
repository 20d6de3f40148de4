"""End-to-end jobs: cleaning, order ETL, warehouse queries, similarity, graph, sales."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe import sinks
from loomframe.operators import clean, layout
from loomframe.plans import etl, graph, sales, similarity, warehouse
from workload.aggregates import RATINGS_SQL, SIMS_SQL, ratings
from workload.registry import Tables, day_text, query

# --- item similarity -------------------------------------------------------------

TARGET = 7


@query(
    f"""
    WITH {SIMS_SQL}
    SELECT CASE WHEN item1 = {TARGET} THEN item2 ELSE item1 END AS item, round(score, 9) AS score,
        num_pairs, s_name AS name
    FROM sims LEFT JOIN supplier ON s_suppkey = CASE WHEN item1 = {TARGET} THEN item2 ELSE item1 END
    WHERE (item1 = {TARGET} OR item2 = {TARGET}) AND score > 0.8 AND num_pairs > 20
    ORDER BY sims.score DESC, item1, item2 LIMIT 10
    """
)
def similar_items(t: Tables):
    sims = similarity.similarity_to_item(ratings(t), "usr", "item", "rating", TARGET)
    names = t.supplier.select("s_suppkey", "s_name")
    best = similarity.similar_items(sims, TARGET, 0.8, 20, 10, names)
    return best.withColumn("score", F.round("score", 9))


@query(f"WITH {RATINGS_SQL} SELECT item, round(avg(rating), 9) AS avg_rating FROM ratings GROUP BY 1")
def item_avg_rating(t: Tables):
    means = similarity.average_rating(ratings(t), "item", "rating")
    return means.withColumn("avg_rating", F.round("avg_rating", 9))


# --- cleaning jobs ---------------------------------------------------------------

# Ids are padded to the usual length and grow beyond it, so that no two rows share one.
ID_RULES = {
    "order_id": r"^\d{6,}$",
    "customer_id": r"^\d{4,}$",
    "product_id": r"^\w\d{4,}$",
}


def _padded(key: str, width: int):
    text = F.col(key).cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), "0")


def _padded_sql(key: str, width: int) -> str:
    return f"lpad(CAST({key} AS VARCHAR), CAST(greatest(length(CAST({key} AS VARCHAR)), {width}) AS INTEGER), '0')"


DIRTY_CUSTOMERS_SQL = f"""
    dirty_customers AS (
        SELECT {_padded_sql('c_custkey', 4)} AS customer_id, ' ' || c_name AS first_name,
            CASE WHEN c_custkey % 17 <> 0 THEN c_name || ' ' END AS last_name,
            CASE WHEN c_custkey % 7 = 0 THEN 'nobody' ELSE 'c' || c_custkey || '@mail.test' END AS email,
            CASE c_custkey % 5 WHEN 0 THEN '(555) 123-4567' WHEN 1 THEN '555-1234'
                ELSE '+1 555.123.4567' END AS phone,
            'N.' || c_nationkey || '-X' AS country, lower(c_mktsegment) AS state,
            CAST(floor(c_acctbal) AS INTEGER) AS loyalty_points
        FROM customer
        UNION ALL
        SELECT {_padded_sql('c_custkey', 4)}, c_name || '  ', c_name, 'c' || c_custkey || '@mail.test',
            '+1 555.123.4567', 'N.' || c_nationkey || '-X', lower(c_mktsegment),
            CAST(floor(c_acctbal) AS INTEGER)
        FROM customer WHERE c_custkey % 10 = 3
    )
"""
CLEAN_CUSTOMERS_SQL = rf"""
    {DIRTY_CUSTOMERS_SQL},
    clean_customers AS (
        SELECT DISTINCT customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
            trim(email) AS email, trim(phone) AS phone,
            regexp_replace(trim(country), '[^a-zA-Z0-9\s]', '', 'g') AS country, upper(trim(state)) AS state,
            CASE WHEN loyalty_points < 0 THEN 0 ELSE loyalty_points END AS loyalty_points
        FROM dirty_customers
        WHERE last_name IS NOT NULL AND regexp_matches(email, '{clean.EMAIL}')
            AND regexp_matches(trim(phone),
                '{clean.PHONE}')
    )
"""


def dirty_customers(t: Tables):
    key, points = F.col("c_custkey"), F.floor("c_acctbal").cast("int").alias("loyalty_points")
    mail = F.concat(F.lit("c"), key.cast("string"), F.lit("@mail.test"))
    phone = F.when(key % 5 == 0, "(555) 123-4567").when(key % 5 == 1, "555-1234")
    number = _padded("c_custkey", 4).alias("customer_id")
    country = F.concat(F.lit("N."), F.col("c_nationkey").cast("string"), F.lit("-X"))
    place = [country.alias("country"), F.lower("c_mktsegment").alias("state")]
    once = t.customer.select(
        number,
        F.concat(F.lit(" "), "c_name").alias("first_name"),
        F.when(key % 17 != 0, F.concat("c_name", F.lit(" "))).alias("last_name"),
        F.when(key % 7 == 0, "nobody").otherwise(mail).alias("email"),
        phone.otherwise("+1 555.123.4567").alias("phone"),
        *place,
        points,
    )
    again = t.customer.where(key % 10 == 3).select(
        number,
        F.concat("c_name", F.lit("  ")).alias("first_name"),
        F.col("c_name").alias("last_name"),
        mail.alias("email"),
        F.lit("+1 555.123.4567").alias("phone"),
        *place,
        points,
    )
    return once.unionByName(again)


# Signs are turned, ids broken and dates lost by fixed rules on the keys.
DIRTY_ORDERS_SQL = f"""
    dirty_orders AS (
        SELECT CASE WHEN l_orderkey % 19 = 0 THEN 'bad' ELSE {_padded_sql('l_orderkey', 6)} END AS order_id,
            {_padded_sql('o_custkey', 4)} AS customer_id,
            CASE WHEN l_partkey % 23 = 0 THEN 'P1' ELSE 'P' || {_padded_sql('l_partkey', 4)} END AS product_id,
            CASE WHEN l_orderkey % 11 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
            CAST(CASE WHEN l_linenumber % 5 = 0 THEN -l_quantity ELSE l_quantity END AS INTEGER) AS quantity,
            CASE WHEN l_linenumber % 5 = 1 THEN -l_extendedprice ELSE l_extendedprice END AS unit_price,
            CASE WHEN l_linenumber % 5 = 2 THEN -o_totalprice ELSE o_totalprice END AS total_amount
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    )
"""
CLEAN_ORDERS_SQL = rf"""
    {DIRTY_ORDERS_SQL},
    clean_orders AS (
        SELECT order_id, customer_id, product_id, order_date, abs(quantity) AS quantity,
            abs(unit_price) AS unit_price, abs(total_amount) AS total_amount
        FROM (SELECT DISTINCT * FROM dirty_orders)
        WHERE regexp_matches(order_id, '^\d{{6,}}$') AND regexp_matches(customer_id, '^\d{{4,}}$')
            AND regexp_matches(product_id, '^\w\d{{4,}}$') AND order_date IS NOT NULL
    )
"""


def dirty_orders(t: Tables):
    lines = t.lineitem
    joined = lines.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    line = F.col("l_linenumber") % 5

    def turned(col: str, rest: int):
        return F.when(line == rest, -F.col(col)).otherwise(F.col(col))

    return joined.select(
        F.when(F.col("l_orderkey") % 19 == 0, "bad")
        .otherwise(_padded("l_orderkey", 6))
        .alias("order_id"),
        _padded("o_custkey", 4).alias("customer_id"),
        F.when(F.col("l_partkey") % 23 == 0, "P1")
        .otherwise(F.concat(F.lit("P"), _padded("l_partkey", 4)))
        .alias("product_id"),
        F.when(F.col("l_orderkey") % 11 != 0, day_text("o_orderdate")).alias("order_date"),
        turned("l_quantity", 0).cast("int").alias("quantity"),
        turned("l_extendedprice", 1).alias("unit_price"),
        turned("o_totalprice", 2).alias("total_amount"),
    )


DIRTY_PRODUCTS_SQL = f"""
    dirty_products AS (
        SELECT CASE WHEN p_partkey % 19 = 0 THEN 'bad' ELSE 'P' || {_padded_sql('p_partkey', 4)} END AS product_id,
            p_name AS product_name, p_type AS category,
            CASE WHEN p_partkey % 3 = 0 THEN -p_retailprice ELSE p_retailprice END AS price,
            CASE WHEN p_partkey % 4 = 0 THEN -p_retailprice / 2 ELSE p_retailprice / 2 END AS cost,
            CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 6 = 0 THEN -p_size ELSE p_size END AS stock_quantity
        FROM (SELECT * FROM part UNION ALL SELECT * FROM part WHERE p_partkey % 5 = 0)
    )
"""
CLEAN_PRODUCTS_SQL = rf"""
    {DIRTY_PRODUCTS_SQL},
    clean_products AS (
        SELECT product_id, product_name, category, abs(price) AS price, abs(cost) AS cost,
            CASE WHEN stock_quantity < 0 THEN 0 ELSE stock_quantity END AS stock_quantity
        FROM (SELECT DISTINCT * FROM dirty_products)
        WHERE regexp_matches(product_id, '^\w\d{{4,}}$') AND stock_quantity IS NOT NULL
    )
"""


def dirty_products(t: Tables):
    key, price, size = F.col("p_partkey"), F.col("p_retailprice"), F.col("p_size")
    number = F.concat(F.lit("P"), _padded("p_partkey", 4))
    copies = F.explode(F.sequence(F.lit(1), F.when(key % 5 == 0, 2).otherwise(1)))
    return t.part.select(
        F.when(key % 19 == 0, "bad").otherwise(number).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.when(key % 3 == 0, -price).otherwise(price).alias("price"),
        F.when(key % 4 == 0, -price / 2).otherwise(price / 2).alias("cost"),
        F.when(key % 13 == 0, None)
        .when(key % 6 == 0, -size)
        .otherwise(size)
        .alias("stock_quantity"),
        copies.alias("copy"),
    ).drop("copy")


def _customers(t: Tables):
    return etl.clean_customers(dirty_customers(t))


def _orders(t: Tables):
    return etl.clean_orders(dirty_orders(t), ID_RULES)


def _products(t: Tables):
    return etl.clean_products(dirty_products(t), {"product_id": ID_RULES["product_id"]})


@query(f"WITH {CLEAN_CUSTOMERS_SQL} SELECT * FROM clean_customers")
def etl_customers(t: Tables):
    return _customers(t)


@query(f"WITH {CLEAN_ORDERS_SQL} SELECT * FROM clean_orders")
def etl_orders(t: Tables):
    return _orders(t)


@query(f"WITH {CLEAN_PRODUCTS_SQL} SELECT * FROM clean_products")
def etl_products(t: Tables):
    return _products(t)


# --- order ETL -------------------------------------------------------------------

ORDER_ETL_SQL = """
    kept AS (
        SELECT DISTINCT o_orderkey AS order_id, CASE WHEN o_orderkey % 9 <> 0 THEN o_custkey ELSE -1 END AS customer_id,
            CASE WHEN o_orderkey % 6 <> 0 THEN o_totalprice ELSE 100 END AS amount
        FROM orders WHERE o_orderkey % 11 <> 0
    ),
    joined AS (
        SELECT k.*, 'city ' || c_nationkey AS city, c_mktsegment AS segment
        FROM kept k JOIN customer ON customer_id = c_custkey
    )
"""


def _order_etl(t: Tables) -> etl.OrderEtl:
    """Orders with lost dates and amounts, and some of a customer that is not known."""
    key = F.col("o_orderkey")
    orders = t.orders.select(
        key.alias("order_id"),
        F.when(key % 9 != 0, F.col("o_custkey")).otherwise(-1).alias("customer_id"),
        F.when(key % 11 != 0, day_text("o_orderdate")).alias("date"),
        F.when(key % 6 != 0, F.col("o_totalprice")).alias("amount"),
    )
    customers = t.customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit("city "), F.col("c_nationkey").cast("string")).alias("city"),
        F.col("c_mktsegment").alias("segment"),
    )
    return etl.order_etl(orders, customers, digits=2)


@query(f"WITH {ORDER_ETL_SQL} SELECT city, round(sum(amount), 2) AS total_sales FROM joined GROUP BY 1")
def etl_sales_by_group(t: Tables):
    return _order_etl(t).sales_by_city


@query(f"WITH {ORDER_ETL_SQL} SELECT segment, round(avg(amount), 4) AS avg_amount FROM joined GROUP BY 1")
def etl_avg_by_segment(t: Tables):
    means = _order_etl(t).average_by_segment
    return means.withColumn("avg_amount", F.round("avg_amount", 4))


@query(
    f"""
    WITH {ORDER_ETL_SQL}
    SELECT customer_id, round(sum(amount), 2) AS total_spending FROM joined GROUP BY 1
    ORDER BY total_spending DESC, customer_id LIMIT 3
    """
)
def etl_top3(t: Tables):
    return _order_etl(t).top_customers


@query(
    f"""
    WITH {ORDER_ETL_SQL}
    SELECT 'city' AS report, city AS name, round(sum(amount), 2) AS amount FROM joined GROUP BY 2
    UNION ALL SELECT 'segment', segment, round(avg(amount), 4) FROM joined GROUP BY 2
    UNION ALL (
        SELECT 'customer', CAST(customer_id AS VARCHAR), round(sum(amount), 2) FROM joined GROUP BY customer_id
        ORDER BY 3 DESC, customer_id LIMIT 3
    )
    """
)
def etl_reports(t: Tables):
    # All reports in one plan, which reads and cleans the orders once.
    made = _order_etl(t)
    city = made.sales_by_city.select(F.lit("city").alias("report"), F.col("city").alias("name"), F.col("total_sales").alias("amount"))
    segment = made.average_by_segment.select(F.lit("segment"), "segment", F.round("avg_amount", 4))
    customer = made.top_customers.select(F.lit("customer"), F.col("customer_id").cast("string"), "total_spending")
    return city.union(segment).union(customer)


# --- warehouse queries -----------------------------------------------------------


@query(f"WITH {CLEAN_CUSTOMERS_SQL} SELECT * FROM clean_customers WHERE loyalty_points > 300")
def wh_loyal(t: Tables):
    return warehouse.loyal_customers(_customers(t))


@query(
    f"""
    WITH {CLEAN_CUSTOMERS_SQL}, {CLEAN_ORDERS_SQL}
    SELECT first_name, last_name, country, round(sum(total_amount), 2) AS total
    FROM clean_customers JOIN clean_orders USING (customer_id)
    GROUP BY customer_id, first_name, last_name, country
    """
)
def wh_spend(t: Tables):
    spent = warehouse.spend_by_customer(_customers(t), _orders(t))
    return spent.withColumn("total", F.round("total", 2))


@query(
    f"""
    WITH {CLEAN_CUSTOMERS_SQL}, {CLEAN_ORDERS_SQL}
    SELECT country, round(avg(total_amount), 4) AS average_spending
    FROM clean_customers JOIN clean_orders USING (customer_id) GROUP BY country
    """
)
def wh_avg_country(t: Tables):
    spent = warehouse.average_spend_by_country(_customers(t), _orders(t))
    return spent.withColumn("average_spending", F.round("average_spending", 4))


@query(
    f"""
    WITH {CLEAN_PRODUCTS_SQL}
    SELECT category, CAST(sum(stock_quantity) AS BIGINT) AS total_stock FROM clean_products GROUP BY 1
    """
)
def wh_stock(t: Tables):
    return warehouse.stock_by_category(_products(t))


@query(
    f"""
    WITH {CLEAN_CUSTOMERS_SQL}, {CLEAN_ORDERS_SQL}, {CLEAN_PRODUCTS_SQL}
    SELECT first_name, last_name, email, product_name
    FROM clean_customers JOIN clean_orders USING (customer_id) JOIN clean_products USING (product_id)
    """
)
def wh_who_bought(t: Tables):
    return warehouse.who_bought_what(_customers(t), _orders(t), _products(t))


# --- graph -----------------------------------------------------------------------

# One line per order line: a supplier, then two or three neighbours.
DEGREE_SQL = """
    degree AS (
        SELECT CAST(l_suppkey AS VARCHAR) AS id,
            CAST(sum(CASE WHEN l_returnflag = 'R' THEN 3 ELSE 2 END) AS BIGINT) AS connections
        FROM lineitem GROUP BY 1
    )
"""


def _degrees(t: Tables):
    third = F.when(F.col("l_returnflag") == "R", F.col("l_linenumber").cast("string"))
    ids = [F.col(c).cast("string") for c in ("l_suppkey", "l_partkey", "l_orderkey")]
    line = F.concat(F.concat_ws(" ", *ids, third), F.when(F.col("l_tax") > 0.04, " ").otherwise(""))
    return graph.degrees(t.lineitem.select(line.alias("value")))


def _names(t: Tables):
    return t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))


@query(f"WITH {DEGREE_SQL} SELECT id, connections FROM degree")
def graph_degree(t: Tables):
    return _degrees(t)


@query(
    f"""
    WITH {DEGREE_SQL} SELECT id, connections, s_name AS name
    FROM degree JOIN supplier ON CAST(s_suppkey AS VARCHAR) = id ORDER BY connections DESC, id LIMIT 1
    """
)
def graph_most(t: Tables):
    return graph.most_connected(_degrees(t), _names(t))


@query(
    f"""
    WITH {DEGREE_SQL} SELECT id, connections, s_name AS name
    FROM degree JOIN supplier ON CAST(s_suppkey AS VARCHAR) = id
    WHERE connections = (SELECT min(connections) FROM degree)
    """
)
def graph_least(t: Tables):
    return graph.least_connected(_degrees(t), _names(t))


# --- sales -----------------------------------------------------------------------


@query("SELECT o_custkey, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def customer_spend(t: Tables):
    return sales.spend_per_customer(t.orders, "o_custkey", "o_totalprice", digits=2)


@query(
    """
    SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (
        SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000)
    """
)
def customers_without_orders(t: Tables):
    large = t.orders.where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 300000))
    orders = large.select(F.col("o_custkey").alias("c_custkey"))
    without = sales.customers_without_orders(t.customer, orders, "c_custkey")
    return without.select("c_custkey", "c_name")


VALID_ORDERS_SQL = r"""
    distinct_orders AS (SELECT DISTINCT * FROM dirty_orders),
    valid_orders AS (
        SELECT *, regexp_matches(order_id, '^\d{6,}$') AS good_order, regexp_matches(customer_id, '^\d{4,}$') AS good_customer,
            regexp_matches(product_id, '^\w\d{4,}$') AS good_product FROM distinct_orders
    )
"""
KEPT_SQL = "good_order AND good_customer AND good_product AND order_date IS NOT NULL"
REPORT_SQL = {
    "order_id_invalid": "NOT good_order",
    "customer_id_invalid": "NOT good_customer",
    "product_id_invalid": "NOT good_product",
    "order_id_null": "NOT good_order",
    "customer_id_null": "NOT good_customer",
    "product_id_null": "NOT good_product",
    "order_date_null": "order_date IS NULL",
    "quantity_null": "quantity IS NULL",
    "unit_price_null": "unit_price IS NULL",
    "total_amount_null": "total_amount IS NULL",
    "rows_with_null": f"NOT ({KEPT_SQL})",
    "rows_distinct": "true",
    "rows_kept": KEPT_SQL,
}


@query(
    f"WITH {DIRTY_ORDERS_SQL}, {VALID_ORDERS_SQL} SELECT 'rows_read' AS metric, count(*) AS n FROM dirty_orders"
    + "".join(f" UNION ALL SELECT '{m}', count(*) FILTER ({c}) FROM valid_orders" for m, c in REPORT_SQL.items())
)
def etl_quality_report(t: Tables):
    # The pass that cleans and writes the orders counts what it drops.
    account = clean.Account()
    cleaned = etl.clean_orders(dirty_orders(t), ID_RULES, account)
    sinks.write_parquet(cleaned, sinks.scratch_dir(t.spark, "clean-orders"))
    return account.report(t.spark)


@query(f"WITH {CLEAN_ORDERS_SQL} SELECT order_date, count(*) AS n, count(DISTINCT customer_id) AS customers FROM clean_orders GROUP BY 1")
def cache_reuse(t: Tables):
    # Clean orders are kept for two results and released again.
    path = sinks.scratch_dir(t.spark, "orders-by-day")
    with layout.reused(_orders(t).select("order_date", "customer_id")) as kept:
        per_day = kept.groupBy("order_date").agg(F.count("*").alias("n"))
        people = kept.groupBy("order_date").agg(F.countDistinct("customer_id").alias("customers"))
        sinks.write_parquet(per_day.join(people, "order_date"), path)
    return t.spark.read.parquet(path)
