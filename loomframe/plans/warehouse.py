"""Warehouse queries over cleaned customers, orders and products.

The SQL takes DataFrames in place of table names, so the same query serves files,
catalog tables and intermediate results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Column types of the passenger table. Fixed values.
PASSENGER_SCHEMA = """
    passenger_id int, survived boolean, p_class int, name string, sex string, age double,
    parch int, ticket string, fare double, cabin string, embarked string
"""


def loyal_customers(customers: DataFrame, above: int = 300) -> DataFrame:
    """Customers with more loyalty points than this."""
    return customers.sparkSession.sql(
        "FROM {customers} |> WHERE loyalty_points > :above",
        args={"above": above},
        customers=customers,
    )


def spend_by_customer(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Name, country and total spent; orders are added up before the join."""
    return customers.sparkSession.sql(
        """
        WITH spent AS (
            SELECT customer_id, sum(total_amount) AS total FROM {orders} GROUP BY customer_id
        )
        SELECT first_name, last_name, country, total
        FROM {customers} JOIN spent USING (customer_id)
        """,
        customers=customers,
        orders=orders,
    )


def average_spend_by_country(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Average order amount per country.

    Sum and count per customer are joined in place of single orders, which gives
    the same average from far fewer rows.
    """
    return customers.sparkSession.sql(
        """
        WITH spent AS (
            SELECT customer_id, sum(total_amount) AS total, count(total_amount) AS n
            FROM {orders} GROUP BY customer_id
        )
        SELECT country, sum(total) / nullif(sum(n), 0) AS average_spending
        FROM {customers} JOIN spent USING (customer_id)
        GROUP BY country
        """,
        customers=customers,
        orders=orders,
    )


def stock_by_category(products: DataFrame) -> DataFrame:
    """Units in stock per category."""
    return products.sparkSession.sql(
        "SELECT category, sum(stock_quantity) AS total_stock FROM {products} GROUP BY category",
        products=products,
    )


def who_bought_what(customers: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """One row per order with the customer's name and mail and the product's name."""
    return customers.sparkSession.sql(
        """
        SELECT first_name, last_name, email, product_name
        FROM {orders}
        JOIN {products} USING (product_id)
        JOIN {customers} USING (customer_id)
        """,
        customers=customers,
        orders=orders,
        products=products,
    )
