from __future__ import annotations

import pytest
from conftest import bag, values
from pyspark.sql import functions as F

from loomframe.operators import clean
from loomframe.plans import etl


def strings(spark, *vals):
    return spark.createDataFrame([(v,) for v in vals], "s string")


def test_dedupe_rows_and_keys(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (None, "x"), (None, "x")], "k int, v string")
    assert bag(clean.dedupe(df)) == {(1, "b"): 1, (1, "a"): 1, (None, "x"): 1}
    assert bag(clean.dedupe(df, ["k"])) == {(1, "a"): 1, (None, "x"): 1}
    assert bag(clean.dedupe(df, ["v", "k"])) == {("b", 1): 1, ("a", 1): 1, ("x", None): 1}


def test_people(spark):
    people = spark.createDataFrame(
        [("Ilse", 12, "Ulm"), ("Piet", None, "Gent"), ("Piet", None, "Gent"), (None, 71, "Gent"), ("Ana", 30, None)],
        "name string, age long, city string",
    )
    assert clean.dedupe(people).count() == 4
    filled = clean.fill_mean(clean.dedupe(people), "age")
    assert values(filled.select("age")) == [12.0, 30.0, 113 / 3, 71.0]
    assert bag(etl.clean_people(people)) == {("Piet", 113 / 3, "Gent"): 1, ("Unknown", 71.0, "Gent"): 1}


def test_fill_mean_of_nothing_stays_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert bag(clean.fill_mean(df, "x")) == {(None,): 2}


def test_fill_const_and_drop_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, "b"), (3, "c")], "x int, s string")
    assert bag(clean.fill_const(df, {"x": 0, "s": "?"})) == {(1, "?"): 1, (0, "b"): 1, (3, "c"): 1}
    assert bag(clean.drop_nulls(df)) == {(3, "c"): 1}
    assert clean.drop_nulls(df, ["x"]).count() == 2


def test_drop_nulls_takes_nan_and_keeps_empty_strings(spark):
    rows = [(1.0, "", 1), (float("nan"), "a", 2), (None, "b", 3), (2.0, None, 4), (0.0, " ", 5)]
    df = spark.createDataFrame(rows, "x double, s string, id int")
    assert values(clean.drop_nulls(df).select("id")) == values(df.dropna().select("id")) == [1, 5]
    assert values(clean.drop_nulls(df, ["s"]).select("id")) == [1, 2, 3, 5]
    assert values(clean.drop_nulls(df, []).select("id")) == [1, 2, 3, 4, 5]


def test_conditions_of_cleaning_go_below_a_join(spark, tmp_path):
    """Each column's rule is a filter of the side that it comes from, before joining and de-duplicating."""
    spark.createDataFrame([("000001", 7)], "order_id string, k long").write.parquet(str(tmp_path / "a"))
    spark.createDataFrame([(7, "0001")], "k long, customer_id string").write.parquet(str(tmp_path / "b"))
    left, right = (spark.read.parquet(str(tmp_path / n)) for n in "ab")
    rules = {"order_id": clean.ORDER_ID, "customer_id": clean.CUSTOMER_ID}
    cleaned = clean.drop_nulls(clean.validate(clean.dedupe(left.join(right, "k")), rules))
    plan = cleaned._jdf.queryExecution().optimizedPlan().toString().splitlines()
    join = next(i for i, line in enumerate(plan) if "Join Inner" in line)
    assert not any("RLIKE" in line and "Filter" in line for line in plan[:join]) and "RLIKE" not in plan[join]
    below = [line for line in plan[join:] if "Filter" in line]
    assert [sum(f"RLIKE({c}" in line for line in below) for c in rules] == [1, 1]
    assert bag(cleaned) == {(7, "000001", "0001"): 1}


def test_trim_touches_strings_only(spark):
    df = spark.createDataFrame([("  a b ", 1)], "s string, n int")
    assert bag(clean.trim_strings(df)) == {("a b", 1): 1}


PHONES = ["555-123-4567", "(555) 123-4567", "+1 555.123.4567", "5551234567"]


@pytest.mark.parametrize(
    ("pattern", "good", "bad"),
    [
        (clean.EMAIL, ["a@b.co", "junk a@b.co junk"], ["nope", ""]),
        (clean.PHONE, PHONES, ["555-1234", "123-45-6789"]),
        (clean.PRODUCT_ID, ["P0001", "10001"], ["P001", "P00011"]),
        (clean.ORDER_ID, ["123456"], ["12345", "1234567", "12345a"]),
        (clean.CUSTOMER_ID, ["1234"], ["123", "A234"]),
    ],
)
def test_validation(spark, pattern, good, bad):
    checked = clean.validate(strings(spark, *good, *bad, None), {"s": pattern})
    assert bag(checked) == {**{(g,): 1 for g in good}, (None,): len(bad) + 1}


def test_anchored_validation(spark):
    df = strings(spark, "a@b.co", "junk a@b.co junk")
    assert bag(clean.validate(df, {"s": clean.EMAIL}, anchored=True)) == {("a@b.co",): 1, (None,): 1}


def test_text_repairs(spark):
    assert values(clean.strip_chars(strings(spark, "U.S.A-1"), "s")) == ["USA1"]
    assert values(clean.upper(strings(spark, "ohio"), "s")) == ["OHIO"]


def test_sign_and_clamp_keep_null_and_type(spark):
    df = spark.createDataFrame([(-2.0, -3), (None, None), (4.0, 5)], "x double, n int")
    fixed = clean.fix_sign(df, ["x", "n"])
    assert bag(fixed) == {(2.0, 3): 1, (None, None): 1, (4.0, 5): 1}
    clamped = clean.clamp_min(clean.clamp_min(df, "x"), "n")
    assert bag(clamped) == {(0.0, 0): 1, (None, None): 1, (4.0, 5): 1}
    assert dict(clamped.dtypes) == {"x": "double", "n": "int"}


CUSTOMER = "customer_id string, first_name string, email string, phone string, country string, state string, loyalty_points int"


def test_customers(spark):
    rows = [
        ("1001", "Ann", "a@b.co", PHONES[0], "U.S.A", "oh", -5),
        ("1001", "Ann ", "a@b.co", PHONES[0], "U.S.A", "oh", -5),
        ("1002", "Bob", "nope", PHONES[0], "USA", "oh", 1),
        ("x", "Cy", "c@d.co", PHONES[1], "USA", "tx", 7),
    ]
    df = spark.createDataFrame(rows, CUSTOMER)
    ann = ("1001", "Ann", "a@b.co", PHONES[0], "USA", "OH", 0)
    cy = ("x", "Cy", "c@d.co", PHONES[1], "USA", "TX", 7)
    assert bag(etl.clean_customers(df)) == {ann: 1, cy: 1}
    assert bag(etl.clean_customers(df, trim_first=False)) == {ann: 2, cy: 1}
    assert bag(etl.clean_customers(df, check_id=True)) == {ann: 1}


def test_orders_and_products(spark):
    orders = spark.createDataFrame(
        [
            ("123456", "1001", "P0001", -2, -9.5, 19.0),
            ("123456", "1001", "P0001", -2, -9.5, 19.0),
            ("12345", "1001", "P0001", 2, 9.5, 19.0),
            ("123457", "1001", "P0001", None, 9.5, 19.0),
        ],
        "order_id string, customer_id string, product_id string, quantity int, unit_price double, total_amount double",
    )
    assert bag(etl.clean_orders(orders)) == {("123456", "1001", "P0001", 2, 9.5, 19.0): 1}
    products = spark.createDataFrame(
        [("P0001", -1.0, -2.0, -3), ("P001", 1.0, 2.0, 3), ("P0002", 1.0, 2.0, None)],
        "product_id string, price double, cost double, stock_quantity int",
    )
    assert bag(etl.clean_products(products)) == {("P0001", 1.0, 2.0, 0): 1}


def test_empty_input(spark):
    empty = spark.createDataFrame([], "name string, age long, city string")
    assert etl.clean_people(empty).count() == 0
    assert clean.dedupe(empty, ["name"]).count() == 0
    assert clean.fill_mean(empty, "age").select(F.col("age")).count() == 0


def test_account_counts_in_the_pass_that_cleans(spark, tmp_path):
    rows = [
        ("000001", "0001", "P0001", 3, 2.0, 9.0), ("000001", "0001", "P0001", 3, 2.0, 9.0), ("1", "0001", "P0001", -3, 2.0, 9.0),
        ("000002", "01", "P1", 3, 2.0, 9.0), ("000003", None, "P0001", 3, 2.0, None), ("000004", "0004", "P0001", 3, -2.0, 9.0),
    ]
    schema = "order_id string, customer_id string, product_id string, quantity int, unit_price double, total_amount double"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    account = clean.Account()
    cleaned = etl.clean_orders(spark.read.parquet(str(tmp_path / "in")), account=account)
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("FileScan") == 1
    cleaned.write.parquet(str(tmp_path / "out"))
    assert account.counts() == {
        "rows_read": 6, "rows_distinct": 5, "order_id_invalid": 1, "customer_id_invalid": 1, "product_id_invalid": 1,
        "order_id_null": 1, "customer_id_null": 2, "product_id_null": 1, "quantity_null": 0, "unit_price_null": 0,
        "total_amount_null": 1, "rows_with_null": 3, "rows_kept": 2,
    }
    assert bag(account.report(spark)) == {(m, n): 1 for m, n in account.counts().items()}
    assert bag(spark.read.parquet(str(tmp_path / "out"))) == bag(etl.clean_orders(spark.createDataFrame(rows, schema)))


def test_accounts_of_customers_and_products(spark):
    people = spark.createDataFrame([(" a ", "x@y.z", "555-123-4567", "n.", "s", -1), ("b", "no", "1", "n", "s", 2)], "first_name string, email string, phone string, country string, state string, loyalty_points int")
    account = clean.Account()
    assert etl.clean_customers(people, account=account).count() == 1
    assert {k: v for k, v in account.counts().items() if v} == {
        "rows_read": 2, "rows_distinct": 2, "email_invalid": 1, "phone_invalid": 1, "email_null": 1, "phone_null": 1,
        "rows_with_null": 1, "rows_kept": 1,
    }
    goods = spark.createDataFrame([("P0001", -1.0, 2.0, -3), ("P1", 1.0, 2.0, 3)], "product_id string, cost double, price double, stock_quantity int")
    account = clean.Account()
    assert etl.clean_products(goods, account=account).count() == 1
    assert account.counts()["product_id_invalid"] == account.counts()["rows_with_null"] == 1
