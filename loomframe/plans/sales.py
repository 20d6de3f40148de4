"""Spending and revenue reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.operators.aggs import total_by
from loomframe.operators.joins import without

# Layout of a sales file. Fixed values.
SALES_SCHEMA = "product_id string, name string, category string, price double, quantity int"


def line_revenue(df: DataFrame, keys: list[str | Column], price: str, quantity: str) -> DataFrame:
    """Price times quantity per line, rounded to two decimals."""
    return df.select(*keys, F.round(F.col(price) * F.col(quantity), 2).alias("revenue"))


def spend_per_customer(
    orders: DataFrame, customer: str, amount: str, digits: int | None = None
) -> DataFrame:
    """Total per customer, largest first."""
    totals = total_by(orders, customer, amount, "total", digits)
    return totals.orderBy(F.desc("total"), F.asc(customer))


def customers_without_orders(customers: DataFrame, orders: DataFrame, key: str) -> DataFrame:
    """Customers that placed no order."""
    return without(customers, orders, key)
