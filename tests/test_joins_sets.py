from __future__ import annotations

import itertools
import random
from collections import Counter

import pytest
from conftest import bag, final_plan, values
from pyspark.sql import functions as F

from loomframe.operators import joins, sets, windows
from loomframe.plans.sales import customers_without_orders


@pytest.fixture
def ports(spark):
    return spark.createDataFrame([(31, "Bergen"), (32, "Vigo"), (None, "nowhere"), (36, "Split")], "id long, name string")


@pytest.fixture
def calls(spark):
    # Calls of ships at ports, two of them at a port that is not listed.
    return spark.createDataFrame([(31, 4), (36, 9), (31, 7), (40, 1), (40, 1), (None, 5)], "id long, ships long")


def test_anti_join(ports, calls):
    assert bag(joins.without(ports, calls, "id")) == {(32, "Vigo"): 1, (None, "nowhere"): 1}
    assert bag(customers_without_orders(ports, calls, "id")) == {(32, "Vigo"): 1, (None, "nowhere"): 1}


def test_lookup_keeps_unknown_keys(ports, calls):
    assert bag(joins.lookup(calls, ports, "id"), "id", "name") == {
        (31, "Bergen"): 2, (36, "Split"): 1, (40, None): 2, (None, None): 1,
    }


def test_aggregate_then_join_equals_join_then_aggregate(ports, calls):
    c = calls.withColumnRenamed("id", "port")
    first = joins.agg_then_join(ports, c, "id", "port", [F.sum("ships").alias("total")])
    after = ports.join(calls, "id").groupBy("id", "name").agg(F.sum("ships").alias("total"))
    assert bag(first) == bag(after) == {(31, "Bergen", 11): 1, (36, "Split", 9): 1}


#: Small enough that the hot keys of a test are split.
SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "12",
}


@pytest.fixture
def skewed(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hot_left_key_of_an_anti_join_is_split(spark, skewed):
    right = spark.range(0, 40_000, 1, 8).select(F.when(F.col("id") < 30_000, 5).otherwise(F.col("id")).alias("k"))
    found = joins.without(skewed, right, "k")
    assert "SortMergeJoin(skew=true)" in final_plan(found)
    assert found.count() == skewed.count() - skewed.where("k = 5 or (k >= 30000 and k < 40000)").count()
    # The copies of the key that fills the right side hardly travel.
    assert joins._few_copies(right, ["k"]).where("k = 5").count() <= joins.COPIES


def test_a_join_with_an_aggregate_on_its_key_is_split(spark, skewed):
    sums = skewed.groupBy("k").agg(F.count("*").alias("n"))
    joined = joins.split_join(skewed, sums, "k")
    assert "SortMergeJoin(skew=true)" in final_plan(joined)
    assert bag(joined.groupBy("n").agg(F.count("*").alias("rows"))) == {(30_000, 30_000): 1, (1, 30_000): 1}
    assert "skew=true" not in final_plan(skewed.join(sums, "k"))


@pytest.mark.parametrize("cells", [4, 1 << 16])
@pytest.mark.parametrize("how", ["inner", "left_semi", "left", "left_anti"])
def test_reduced_join_equals_plain_join(spark, how, cells):
    rng = random.Random(9)
    big = spark.createDataFrame([(rng.choice([None, *range(300)]), i) for i in range(500)], "k int, v int")
    small = spark.createDataFrame([(rng.choice([None, *range(0, 600, 3)]), f"n{i}") for i in range(60)], "k long, name string")
    reduced = joins.reduced_join(big, small, "k", how, cells=cells)
    plain = big.join(small.withColumn("k", F.col("k").cast("int")), "k", how)
    assert reduced.columns == plain.columns and bag(reduced) == bag(plain)


def test_reduced_join_shuffles_less(spark, skewed):
    small = spark.range(0, 60_000, 999).select(F.col("id").alias("k"))

    def shuffled(df) -> int:
        final_plan(df)
        plan, total = [df._jdf.queryExecution().executedPlan()], 0
        while plan:
            node = plan.pop()
            name = node.getClass().getSimpleName()
            if name == "AdaptiveSparkPlanExec":
                plan.append(node.executedPlan())
            elif name.endswith("QueryStageExec"):
                plan.append(node.plan())
            elif name == "ShuffleExchangeExec":
                total += node.metrics().apply("shuffleBytesWritten").value()
            children = node.children()
            plan += [children.apply(i) for i in range(children.size())]
        return total

    plain, reduced = skewed.join(small, "k"), joins.reduced_join(skewed, small, "k")
    assert bag(plain, "k") == bag(reduced, "k")
    assert shuffled(reduced) < shuffled(plain) / 10


def test_reduced_join_refuses_other_kinds(ports, calls):
    with pytest.raises(ValueError, match="left_anti"):
        joins.reduced_join(ports, calls, "id", "outer")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, how):
    rng = random.Random(5)
    keys = [7] * 600 + [None] * 300 + [rng.randrange(50) for _ in range(100)]
    big = spark.createDataFrame([(k, i % 3) for i, k in enumerate(keys)], "k int, v int").repartition(3)
    small = spark.createDataFrame([(k, f"n{k}", c) for k in range(40) for c in (1, 2)], "k int, name string, c int")
    salted = joins.salted_join(big, small, ["k"], salts=8, how=how, min_rows=10)
    assert bag(salted) == bag(big.join(small, "k", how))


def test_salted_join_on_two_keys(spark):
    big = spark.range(900).select((F.col("id") % 2).alias("a"), F.lit("x").alias("b"), "id")
    small = spark.createDataFrame([(0, "x", 1), (1, "x", 2), (1, "y", 3)], "a long, b string, w int")
    salted = joins.salted_join(big, small, ["a", "b"], salts=4, min_rows=10)
    assert bag(salted) == bag(big.join(small, ["a", "b"]))


def test_salted_join_refuses_other_kinds(spark):
    with pytest.raises(ValueError):
        joins.salted_join(spark.range(1), spark.range(1), ["id"], how="full")


def brute_pairs(rows):
    by_key = {}
    for k, item, value in rows:
        if k is not None and item is not None:
            by_key.setdefault(k, []).append((item, value))
    found = Counter()
    for k, items in by_key.items():
        for (i, v), (j, w) in itertools.permutations(items, 2):
            if i < j:
                found[(k, i, j, v, w)] += 1
    return found


@pytest.mark.parametrize("hot_share", [1e-4, 0.3, 1.0])
@pytest.mark.parametrize("block", [1, 7, 1000])
def test_pairs_equal_brute_force_for_any_block_size(spark, block, hot_share):
    rng = random.Random(block)
    rows = [(rng.choice([1, 1, 1, 2, 3, None]), rng.randrange(25), rng.choice([1, 2, None])) for _ in range(120)]
    rows += [(9, i, 1) for i in range(40)] + [(4, None, 1), (5, 1, 2)]
    df = spark.createDataFrame(rows, "u int, i int, r int")
    assert bag(joins.pairs(df, "u", "i", "r", block, hot_share)) == brute_pairs(rows)
    without_value = Counter()
    for (k, i, j, _, _), n in brute_pairs(rows).items():
        without_value[(k, i, j)] += n
    found = joins.pairs(df, "u", "i", block=block, hot_share=hot_share)
    assert bag(found) == without_value


def test_a_row_of_a_large_key_travels_a_bounded_number_of_times(spark):
    df = spark.range(400).select(F.lit(1).alias("u"), F.col("id").alias("item"), F.lit(400).alias("_n"))
    left, right, _ = joins._cells_of_large(df, "u", False, 1)
    assert left.count() + right.count() == 400 * (joins.BLOCKS + 1)
    assert joins.pairs(df, "u", "item", block=1, hot_share=0.5).count() == 400 * 399 / 2


@pytest.mark.parametrize("min_rows", [1, 30, 1_000_000])
def test_pair_sums_are_those_of_the_pairs(spark, min_rows):
    """Items that repeat, NULL keys, items and values, a key without a pair, one that is cut into slices."""
    rng = random.Random(min_rows)
    rows = [(rng.choice([1, 1, 1, 2, 3, None]), rng.randrange(25), rng.choice([1, -2, None])) for _ in range(120)]
    rows += [(9, i, 7 - i) for i in range(300)] + [(4, None, 1), (5, 1, 2), (5, 1, 3), (6, 1, 2), (6, 2, None)]
    df = spark.createDataFrame(rows, "u int, i int, r int").repartition(3)
    one, r = F.lit(1), F.col("r")
    sums = {"n": (one, one), "low": (F.col("i"), one), "high": (one, F.col("i")), "dot": (r, r), "mixed": (r, F.col("i"))}
    found = windows.pair_sums(df, "u", "i", sums, share=0.05, min_rows=min_rows)
    paired = joins.pairs(df, "u", "i", "r").groupBy("u").agg(
        F.count("*"), F.sum("item1"), F.sum("item2"), F.sum(F.col("value1") * F.col("value2")), F.sum(F.col("value1") * F.col("item2"))
    )
    assert bag(found) == bag(paired) and found.count() == 5


def test_pair_sums_form_no_pairs(spark):
    """A key of 60,000 rows has 1.8 billion pairs."""
    df = spark.range(60_000, numPartitions=4).select(F.lit(1).alias("u"), "id")
    one = F.lit(1)
    found = windows.pair_sums(df, "u", "id", {"n": (one, one), "low": (F.col("id"), one)}, min_rows=10_000).first()
    assert found.n == 60_000 * 59_999 // 2 and found.low == sum(i * (59_999 - i) for i in range(60_000))


def test_pairs_of_nothing(spark):
    assert joins.pairs(spark.createDataFrame([], "u int, i int"), "u", "i").count() == 0


def numbers(spark, *vals):
    return spark.createDataFrame([(v,) for v in vals], "n int")


def test_sets(spark):
    a, b = numbers(spark, 1, 2, 3, 4, 5), numbers(spark, 4, 5, 6, 7, 8)
    assert sets.union_all(a, b).count() == 10
    assert values(sets.intersect(a, b)) == [4, 5]
    assert values(sets.subtract(a, b)) == [1, 2, 3]


def test_repeats_and_nulls_in_sets(spark):
    a, b = numbers(spark, 1, 1, 2, 3, 3, None, None), numbers(spark, 2, 1, 1)
    assert bag(sets.subtract(a, b)) == {(3,): 2, (None,): 2}
    assert bag(sets.subtract(a, b, dedupe=True)) == {(3,): 1, (None,): 1}
    assert bag(sets.intersect(a, b)) == {(1,): 1, (2,): 1}
    assert bag(sets.intersect(a, numbers(spark, None))) == {(None,): 1}
    assert bag(sets.subtract(a, numbers(spark, None))) == {(1,): 2, (2,): 1, (3,): 2}
    assert sets.subtract(a, a).count() == 0


def test_set_columns_are_matched_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([("x", 1)], "s string, k int")
    assert sets.union_all(a, b).distinct().count() == 1
    assert sets.intersect(a, b).count() == 1
    assert sets.subtract(a, b).count() == 0
