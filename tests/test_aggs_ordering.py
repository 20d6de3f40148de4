from __future__ import annotations

import pytest
from conftest import bag, final_plan, values
from pyspark.sql import functions as F

from loomframe.functions import exact_sum
from loomframe.operators import aggs, layout, ordering


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(
        [("mill", "rye", 31), ("mill", "oats", 8), ("mill", "rye", 2), ("barn", "hay", 24)],
        "customer string, product string, amount long",
    )


@pytest.fixture
def numbers(spark):
    return spark.createDataFrame([(n,) for n in (-4, 17, 17, 0, 256, 33)], "n long")


def test_totals_means_and_best_customer(sales):
    totals = aggs.total_by(sales, "customer", "amount")
    assert bag(totals) == {("mill", 41): 1, ("barn", 24): 1}
    assert bag(aggs.mean_by(sales, ["customer"], "amount")) == {("mill", 41 / 3): 1, ("barn", 24.0): 1}
    assert sales.agg(F.round(F.avg("amount"), 2)).first()[0] == 16.25
    assert ordering.argmax(totals, "total", "customer").first()[0] == "mill"


def test_exact_totals_do_not_depend_on_order(spark):
    rows = [(0.1,)] * 10 + [(1e9 + 0.01,), (-1e9,)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "x double")
        assert df.agg(exact_sum("x")).first()[0] == 1.01
    df = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("a", None)], "k string, x double")
    assert bag(aggs.total_by(df, "k", "x", digits=2)) == {("a", 0.3): 1}
    assert bag(aggs.mean_by(df, "k", "x", digits=2)) == {("a", 0.15): 1}


def test_counts(spark):
    df = spark.createDataFrame([("x", 1), ("x", None), ("y", None), (None, 2)], "k string, v int")
    assert bag(aggs.count_by(df, "k")) == {("x", 2): 1, ("y", 1): 1, (None, 1): 1}
    assert bag(aggs.count_by(df, "k", "v")) == {("x", 1): 1, ("y", 0): 1, (None, 1): 1}


def test_reduce_fold_and_extremes(numbers):
    assert bag(aggs.summarize(numbers, "n")) == {(319, 256, -4): 1}
    assert aggs.fold_sum(numbers, "n").first()[0] == 319
    assert aggs.fold_sum(numbers.limit(0), "n", zero=5).first()[0] == 5
    assert [r[0] for r in ordering.largest(numbers, "n", 3).collect()] == [256, 33, 17]
    assert [r[0] for r in ordering.smallest(numbers, "n", 3).collect()] == [-4, 0, 17]


def test_value_counts_and_duplicates(spark):
    winds = spark.createDataFrame([(c,) for c in ("NW", "S", "NW", None, "calm", "S", "NW", "S", None)], "c string")
    assert bag(aggs.value_counts(winds, "c")) == {("NW", 3): 1, ("S", 3): 1, (None, 2): 1, ("calm", 1): 1}
    assert bag(aggs.find_duplicates(winds, "c")) == {("NW", 3): 1, ("S", 3): 1, (None, 2): 1}
    assert winds.distinct().count() == 4


def test_pivot(spark):
    monthly = spark.createDataFrame(
        [("dry", "wells", 7), ("wet", "wells", 1), ("wet", "dams", 4), ("wet", "dams", 2)],
        "season string, source string, sales long",
    )
    expected = {("dry", 7, None): 1, ("wet", 1, 6): 1}
    assert bag(aggs.pivot_sum(monthly, "season", "source", "sales"), "season", "wells", "dams") == expected
    named = aggs.pivot_sum(monthly, "season", "source", "sales", ["wells", "dams", "snow"])
    assert named.columns == ["season", "wells", "dams", "snow"]
    assert bag(named, "season", "wells", "dams") == expected


def test_salted_aggregate_equals_plain(spark):
    df = spark.range(2000).select(
        F.when(F.col("id") < 1800, 1).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 5 > 0, F.col("id")).alias("v"),
    )
    plain = df.groupBy("k").agg(F.sum("v"), F.count("v"))
    assert bag(aggs.salted_agg(df, "k", "v", salts=8)) == bag(plain)


def test_a_task_sends_one_partial_row_per_key(spark):
    rows = spark.range(0, 4000, numPartitions=4).selectExpr("id % 2 AS k", "id AS v")
    plan = final_plan(aggs.salted_agg(rows, "k", "v", salts=16))
    df = aggs.salted_agg(rows, "k", "v", salts=16)
    df.toArrow()
    first = rows.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(16))).select("k", "_salt").distinct()
    assert first.count() == 8 and "xxhash64" not in plan


def test_copies_of_one_row_spread_over_salts(spark):
    copies = spark.range(4000).select(F.lit(1).alias("k")).repartition(40)
    assert copies.select(aggs.salt(copies, 8).alias("s")).distinct().count() > 4


def test_top_k_breaks_ties_by_the_last_column(spark):
    df = spark.createDataFrame([(3, 400), (1, 400), (2, 130)], "id int, v int")
    assert [r[0] for r in ordering.top_k(df, [F.desc("v"), "id"], 2).collect()] == [1, 3]
    assert ordering.argmax(df, "v", "id").first()[0] == 1


def test_all_rows_at_the_minimum(spark):
    df = spark.createDataFrame([(1, 4), (2, 3), (3, 3), (4, None)], "id int, v int")
    assert values(ordering.argmin_all(df, "v").select("id")) == [2, 3]
    assert ordering.argmin_all(df.limit(0), "v").count() == 0


def test_partition_profile_and_layout(spark):
    users = spark.range(1, 31).repartition(10)
    for df, parts in ((users, 10), (users.repartition(3), 3), (users.coalesce(3), 3)):
        assert df.rdd.getNumPartitions() == parts
        profile = layout.partition_profile(df)
        assert profile.agg(F.sum("n_rows")).first()[0] == 30
        assert profile.count() == parts


def test_key_skew(spark):
    df = spark.createDataFrame([(k,) for k in "aaaaaabbcd"], "k string")
    report = layout.key_skew(df, ["k"], 2)
    assert [tuple(r) for r in report.collect()] == [("a", 6, 0.6), ("b", 2, 0.2)]


def test_hot_keys_are_exact(spark):
    df = spark.range(100_000).select(
        F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 10 == 1, None).otherwise(F.col("id")).alias("k")
    )
    hot = layout.hot_keys(df, ["k"], share=0.05, min_rows=100, extra=(F.count("*").alias("n"),))
    expected = df.groupBy("k").count().where("count > 5000")
    assert bag(hot, "k", "n") == bag(expected)
    assert layout.hot_keys(df, ["k"], min_rows=50_000).count() == 0
    assert layout.hot_keys(df.limit(0), ["k"], min_rows=1).count() == 0


def test_many_hot_keys_are_all_found(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 2 == 0, F.col("id") % 60).otherwise(F.col("id")).alias("k")
    )
    hot = layout.hot_keys(df, ["k"], share=0.01, min_rows=10)
    assert values(hot) == list(range(0, 60, 2))


def test_reused_result_is_released(spark):
    with layout.reused(spark.range(10)) as df:
        assert df.count() == df.count() == 10
        assert df.is_cached
    assert not df.is_cached


def test_pivot_becomes_a_map_beyond_the_limit(spark):
    rows = [("r", "x", 1), ("r", "x", 2), ("r", "y", 5), ("s", None, 7), (None, "z", None)]
    df = spark.createDataFrame(rows, "row string, col string, value long")
    wide = aggs.pivot_or_map(df, "row", "col", "value", limit=4)
    assert wide.columns == ["row", "null", "x", "y", "z"]
    assert bag(wide) == {("r", None, 3, 5, None): 1, ("s", 7, None, None, None): 1, (None, None, None, None, None): 1}
    found = aggs.pivot_or_map(df, "row", "col", "value", limit=3)
    assert {r["row"]: r.by_value for r in found.collect()} == {"r": {"x": 3, "y": 5}, "s": {"null": 7}, None: {"z": None}}


def test_pivot_of_very_many_values(spark):
    df = spark.range(30_000).select((F.col("id") % 3).alias("row"), F.col("id").alias("col"), F.lit(1).alias("value"))
    found = aggs.pivot_or_map(df, "row", "col", "value", limit=100)
    assert len(found.columns) == 2 and found.agg(F.sum(F.size("by_value"))).first()[0] == 30_000
