"""Cleaning jobs for customer, order, product and people tables, and the order ETL."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.functions.numeric import exact_sum
from loomframe.operators import clean as c
from loomframe.operators.aggs import total_by
from loomframe.operators.layout import reused
from loomframe.operators.ordering import top_k
from loomframe.sinks.files import write_partitioned

# File layouts of the cleaning jobs. Fixed values.
ORDERS_SCHEMA = """
    order_id string, customer_id string, product_id string, order_date date, ship_date date,
    quantity int, unit_price float, discount_pct float, total_amount float,
    payment_method string, order_status string
"""
PRODUCTS_SCHEMA = """
    product_id string, product_name string, category string, brand string, price float,
    cost float, stock_quantity int, weight_kg float, created_date date, is_active boolean
"""
CUSTOMERS_SCHEMA = """
    customer_id string, first_name string, last_name string, email string, phone string,
    signup_date date, country string, state string, postal_code string, is_active boolean,
    loyalty_points int
"""


ORDER_RULES = {"order_id": c.ORDER_ID, "customer_id": c.CUSTOMER_ID, "product_id": c.PRODUCT_ID}
PRODUCT_RULES = {"product_id": c.PRODUCT_ID}


def _counted_in(df: DataFrame, name: str, account: c.Account | None) -> DataFrame:
    return df if account is None else account.watch(df, {name: F.count("*")})


def clean_customers(
    df: DataFrame, trim_first: bool = True, check_id: bool = False, account: c.Account | None = None
) -> DataFrame:
    """Trimmed, distinct customers with valid mail and phone and no missing value.

    ``trim_first`` removes rows that differ in outer spaces only; without it such
    rows stay. ``check_id`` also asks for a four-digit customer id. ``account`` counts
    what goes.
    """
    df = _counted_in(df, "rows_read", account)
    df = c.dedupe(c.trim_strings(df)) if trim_first else c.trim_strings(c.dedupe(df))
    df = _counted_in(df, "rows_distinct", account)
    rules = {"email": c.EMAIL, "phone": c.PHONE}
    if check_id:
        rules["customer_id"] = c.CUSTOMER_ID
    df = c.validate(df, rules, account=account)
    df = c.strip_chars(df, "country")
    df = c.upper(df, "state")
    df = c.clamp_min(df, "loyalty_points")
    return _counted_in(c.drop_nulls(df, account=account), "rows_kept", account)


def clean_orders(
    df: DataFrame, rules: dict[str, str] = ORDER_RULES, account: c.Account | None = None
) -> DataFrame:
    """Distinct orders with valid ids, positive amounts and no missing value.

    ``rules`` are patterns per column, for ids of another form than the default.
    ``account`` counts what goes.
    """
    df = _counted_in(c.dedupe(_counted_in(df, "rows_read", account)), "rows_distinct", account)
    df = c.fix_sign(c.validate(df, rules, account=account), ["quantity", "unit_price", "total_amount"])
    return _counted_in(c.drop_nulls(df, account=account), "rows_kept", account)


def clean_products(
    df: DataFrame, rules: dict[str, str] = PRODUCT_RULES, account: c.Account | None = None
) -> DataFrame:
    """Distinct products with a valid id, positive prices, stock of at least 0, no NULL; ``account`` counts what goes."""
    df = _counted_in(c.dedupe(_counted_in(df, "rows_read", account)), "rows_distinct", account)
    df = c.validate(df, rules, account=account)
    df = c.clamp_min(c.fix_sign(df, ["cost", "price"]), "stock_quantity")
    return _counted_in(c.drop_nulls(df, account=account), "rows_kept", account)


def clean_people(df: DataFrame, older_than: float = 30) -> DataFrame:
    """Distinct people, missing ages set to the mean and names to Unknown, above an age."""
    df = c.fill_mean(c.dedupe(df), "age")
    return c.fill_const(df, {"name": "Unknown"}).where(F.col("age") > older_than)


@dataclass(frozen=True)
class OrderEtl:
    """The joined orders and the reports made from them, all lazy."""

    joined: DataFrame
    sales_by_city: DataFrame
    average_by_segment: DataFrame
    top_customers: DataFrame

    def write(self, path: str) -> None:
        """Joined orders in one directory per city."""
        write_partitioned(self.joined, path, "city")


def order_etl(
    orders: DataFrame,
    customers: DataFrame,
    default_amount: float = 100,
    top: int = 3,
    digits: int | None = None,
) -> OrderEtl:
    """Clean orders, join the customers, report by city, segment and customer.

    The reports add up the orders per customer before they join, so only one row
    per customer is shuffled; top customers need the join just to leave out
    orders of unknown ones. ``digits`` sums amounts with that many decimals exactly.
    """
    return _outputs(_kept_orders(orders, default_amount), customers, top, digits)


@contextmanager
def shared_order_etl(
    orders: DataFrame,
    customers: DataFrame,
    default_amount: float = 100,
    top: int = 3,
    digits: int | None = None,
) -> Iterator[OrderEtl]:
    """``order_etl`` for several outputs: inside the ``with`` block orders are read and cleaned once.

    The clean orders are kept in memory and on disk with their lineage and released at the end.
    """
    with reused(_kept_orders(orders, default_amount)) as kept, reused(customers) as known:
        yield _outputs(kept, known, top, digits)


def _kept_orders(orders: DataFrame, default_amount: float) -> DataFrame:
    kept = c.fill_const(orders, {"amount": default_amount}).where(F.col("date").isNotNull())
    return c.dedupe(kept)


def _outputs(kept: DataFrame, customers: DataFrame, top: int, digits: int | None) -> OrderEtl:
    total = F.sum("amount") if digits is None else exact_sum("amount", digits)
    spent = kept.groupBy("customer_id").agg(
        total.alias("total_spending"), F.count("amount").alias("n_orders")
    )
    per_customer = customers.join(spent, "customer_id")
    segments = per_customer.groupBy("segment").agg(
        (exact_sum("total_spending", digits) if digits is not None else F.sum("total_spending")).alias("_sum"),
        F.sum("n_orders").alias("_n"),
    )
    return OrderEtl(
        joined=customers.join(kept, "customer_id"),
        sales_by_city=total_by(per_customer, "city", "total_spending", "total_sales", digits),
        average_by_segment=segments.select(
            "segment", (F.col("_sum") / F.col("_n")).alias("avg_amount")
        ),
        top_customers=top_k(
            total_by(per_customer, "customer_id", "total_spending", "total_spending", digits),
            [F.desc("total_spending"), F.asc("customer_id")],
            top,
        ),
    )
