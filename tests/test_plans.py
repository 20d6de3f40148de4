from __future__ import annotations

import math
import os
import random
from collections import defaultdict

import pyarrow as pa
import pytest
from conftest import bag, final_plan
from pyspark.sql import functions as F

from loomframe import sinks, sources
from loomframe.operators import joins
from loomframe.plans import etl, sales, similarity, warehouse


@pytest.fixture
def ratings(spark):
    rows = [(1, 10, 5), (1, 20, 3), (1, 30, 4), (2, 10, 4), (2, 20, 2), (3, 10, 1), (3, 30, 5)]
    return spark.createDataFrame(rows, "user int, item int, rating int")


def rounded(df):
    return {(r.item1, r.item2): (round(r.score, 6), r.num_pairs) for r in df.collect()}


def test_similarity(ratings):
    sims = similarity.item_similarity(ratings, "user", "item", "rating")
    expected = {(10, 20): (0.996241, 2), (10, 30): (0.765705, 2), (20, 30): (1.0, 1)}
    assert rounded(sims) == expected
    frequent = similarity.item_similarity(ratings, "user", "item", "rating", min_pairs=2)
    assert rounded(frequent) == {k: v for k, v in expected.items() if v[1] >= 2}
    for target in (10, 20, 30, 99):
        one = similarity.similarity_to_item(ratings, "user", "item", "rating", target)
        assert rounded(one) == {k: v for k, v in expected.items() if target in k}


def test_score_is_zero_without_a_norm(spark):
    df = spark.createDataFrame([(1, 1, 0.0), (1, 2, 3.5)], "user int, item int, rating double")
    assert rounded(similarity.item_similarity(df, "user", "item", "rating")) == {(1, 2): (0.0, 1)}


def similarity_by_hand(rows):
    by_user = defaultdict(list)
    for u, i, r in rows:
        by_user[u].append((i, r))
    sums = defaultdict(lambda: [0, 0, 0, 0])
    for items in by_user.values():
        for i, r in items:
            for j, s in items:
                if i < j:
                    cell = sums[(i, j)]
                    cell[0] += r * s
                    cell[1] += r * r
                    cell[2] += s * s
                    cell[3] += 1
    return {k: (round(a / math.sqrt(b) / math.sqrt(c), 6), n) for k, (a, b, c, n) in sums.items()}


@pytest.mark.parametrize("block", [4, 2048])
def test_similarity_with_a_hot_user_equals_brute_force(spark, block):
    rng = random.Random(3)
    rows = [(0, i, 1 + i % 5) for i in range(60)]
    rows += list({(u, i): (u, i, rng.randrange(1, 6)) for u, i in
                  ((rng.randrange(1, 30), rng.randrange(60)) for _ in range(150))}.values())
    df = spark.createDataFrame(rows, "user int, item int, rating int").repartition(3)
    expected = similarity_by_hand(rows)
    assert rounded(similarity.item_similarity(df, "user", "item", "rating", block=block)) == expected
    frequent = similarity.item_similarity(df, "user", "item", "rating", min_pairs=3, block=block)
    assert rounded(frequent) == {k: v for k, v in expected.items() if v[1] >= 3}


@pytest.mark.parametrize("block", [4, 2048])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_similarity_is_that_of_the_pairs(spark, monkeypatch, kind, block):
    """Items rated often and seldom, ratings that repeat, NULL users, items and ratings, numbers too large for narrow lists."""
    monkeypatch.setattr(similarity, "OFTEN", 0.03)
    rng = random.Random(block)
    rows = [(rng.choice([None, *range(12), *range(60)]), rng.choice([None, *range(6), *range(80)]), rng.choice([None, 300, -5, 1, 2])) for _ in range(420)]
    rows += [(5, 1 << 40, 3), (6, 1 << 40, 3), (6, -(1 << 40), 2)] + [(99, 70, 3)] * 2 + [(99, 71, 2)]
    number = "long" if kind == "long" else "double"
    df = spark.createDataFrame(rows, "u int, i long, r long").select("u", F.col("i").cast(kind).alias("i"), F.col("r").cast(number).alias("r"))
    x, y = F.col("value1"), F.col("value2")
    norms = F.sqrt(F.sum(x * x)) * F.sqrt(F.sum(y * y))
    score = F.when(norms != 0, F.sum(x * y) / norms).otherwise(0.0)
    plain = joins.pairs(df, "u", "i", "r").groupBy("item1", "item2").agg(F.round(score, 9), F.count(x * y))
    found = similarity.item_similarity(df, "u", "i", "r", block=block)
    assert bag(found.withColumn("score", F.round("score", 9))) == bag(plain)


def test_similarity_sends_lists_and_not_pairs(spark):
    """Users with 40 of 4,000 items each: hardly a pair repeats, so partial sums would be one row of 50 bytes or more for each pair."""
    df = spark.range(500).select(F.col("id").alias("u"), F.explode(F.sequence(F.lit(0), F.lit(39))).alias("k"))
    df = df.select("u", F.pmod(F.xxhash64("u", "k"), F.lit(4000)).alias("i"), F.lit(3).alias("r")).distinct()
    lists = similarity._lists(df.select("u", F.col("i").alias("item"), F.col("r").cast("long").alias("value")), "u")
    rows, pairs, wide = lists.agg(F.count("*"), F.sum(F.size("near") * F.size("low") / F.size("near")), F.count("far") + F.count("high")).first()
    assert wide == 0 and pairs == joins.pairs(df, "u", "i").count() and rows * 15 < pairs
    assert dict(lists.dtypes)["near"] == "array<int>" and dict(lists.dtypes)["low"] == "array<tinyint>"


def test_similarity_with_min_pairs_sends_lists(spark):
    """Ratings that repeat; what is shuffled last is lists by the smaller item, and no sums by pair follow."""
    rows = [(u, (u + k) % 2500, 1 + k % 5) for u in range(60) for k in (0, 0, 1, 700, 700, 1400)]
    df = spark.createDataFrame(rows, "u int, i int, r int")
    found = similarity.item_similarity(df, "u", "i", "r", min_pairs=4)
    assert bag(found) == bag(similarity.item_similarity(df, "u", "i", "r").where("num_pairs >= 4")) and found.count() > 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    last = next(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
    assert "hashpartitioning(item1#" in last and "REPARTITION_BY_COL" in last


def test_sums_of_pairs_are_given_out_item_by_item():
    """A task holds the pairs of one item: those of the first ones are out before the last ones are read."""
    schema = pa.schema([
        ("item1", pa.int64()), ("value1", pa.int64()), ("near", pa.list_(pa.int32())), ("far", pa.list_(pa.int64())),
        ("low", pa.list_(pa.int8())), ("high", pa.list_(pa.int64())), ("folded", pa.struct([(c, pa.int64()) for c in ("xy", "xx", "yy", "n")])),
    ])
    rng, expected, read = random.Random(1), defaultdict(lambda: [0, 0, 0, 0]), []

    def batches():
        for item in range(200):
            rows = [{"item1": item, "far": [item + 1], "folded": {"xy": 2, "xx": 1, "yy": 4, "n": 1}}]
            for x in (1, None, 400_000_000 if item % 50 == 0 else 5):
                others = [item, *sorted(rng.choices(range(item + 1, item + 40), k=20))]
                values = [rng.choice([None, -3, 2]) for _ in others]
                wide = {"far": [*others, 1 << 40], "high": [*values, 300]} if x == 5 else {"near": others, "low": values}
                rows.append({"item1": item, "value1": x} | wide)
            for r in rows:
                if r.get("folded"):
                    found = [(r["far"][0], r["folded"].values())]
                else:
                    both, x = zip(r.get("far", r.get("near")), r.get("high", r.get("low"))), r["value1"] or 0
                    found = [(j, (x * (y or 0), x * x, (y or 0) ** 2, r["value1"] is not None and y is not None)) for j, y in both if j != item]
                for j, terms in found:
                    expected[item, j] = [a + b for a, b in zip(expected[item, j], terms)]
            read.append(item)
            yield pa.RecordBatch.from_pylist(rows, schema)

    for least in (1, 2):
        expected.clear()
        read.clear()
        got, early = {}, None
        for b in similarity._sum_lists(least, 64)(batches()):
            early = len(read) if early is None else early
            got |= {(r["item1"], r["item2"]): [r[c] or 0 for c in ("xy", "xx", "yy", "n")] for r in b.to_pylist()}
        assert early < 10 and got == {k: v for k, v in expected.items() if least < 2 or v[3] >= least}
    # As in Spark, no sum wraps around.
    rows = [{"item1": 1, "value1": 3_000_000_000, "near": [2], "low": [1]}] * 2
    with pytest.raises(pa.ArrowInvalid):
        list(similarity._sum_lists(1, 64)([pa.RecordBatch.from_pylist(rows, schema)]))


def test_similarity_holds_no_table_of_pairs(spark):
    """After the last shuffle pairs are summed in the order of their smaller item, and lists are made without an aggregate of lists."""
    df = spark.createDataFrame([(u, i, 3) for u in range(5) for i in range(4)], "u int, i int, r int")
    plan = similarity.item_similarity(df, "u", "i", "r", min_pairs=2)._jdf.queryExecution().executedPlan().toString()
    above = plan.split("REPARTITION_BY_COL")[0]
    assert "MapInArrow" in above and "HashAggregate" not in above and "ObjectHashAggregate" not in plan


def test_similar_items_lookup(spark, ratings):
    sims = similarity.item_similarity(ratings, "user", "item", "rating")
    names = spark.createDataFrame([(20, "Twenty"), (30, "Thirty")], "m int, t string")
    best = similarity.similar_items(sims, 10, min_score=0.5, min_pairs=1, names=names)
    assert [(r.item, r.name) for r in best.orderBy(F.desc("score")).collect()] == [
        (20, "Twenty"), (30, "Thirty"),
    ]
    assert similarity.similar_items(sims, 10).count() == 0
    assert similarity.similar_items(sims, 10, 0.5, 1, k=1).first().item == 20


def test_average_rating(ratings):
    means = [tuple(r) for r in similarity.average_rating(ratings, "item", "rating").collect()]
    assert means == [(30, 4.5), (10, 10 / 3), (20, 2.5)]


ORDERS = [
    (71, 5, "12 May", 40), (72, 5, None, 9), (73, 6, "1 June", None), (74, 6, "1 June", 7),
    (75, 8, "", 250), (76, 99, "2 June", 500), (77, 7, "3 June", 0), (78, 8, "4 June", 1),
]


@pytest.fixture
def etl_tables(spark):
    orders = spark.createDataFrame(ORDERS, "order_id int, customer_id int, date string, amount long")
    customers = spark.createDataFrame(
        [(5, "Skye", "boat"), (6, "Mull", "boat"), (7, "Skye", "shop"), (8, "Mull", "shop"), (9, "Jura", "shop")],
        "customer_id int, city string, segment string",
    )
    return orders.unionAll(orders), customers


@pytest.mark.parametrize("digits", [None, 2])
def test_order_etl(spark, tmp_path, etl_tables, digits):
    out = etl.order_etl(*etl_tables, digits=digits)
    assert out.joined.count() == 6
    assert bag(out.sales_by_city) == {("Skye", 40.0): 1, ("Mull", 358.0): 1}
    means = {r.segment: round(r.avg_amount, 2) for r in out.average_by_segment.collect()}
    assert means == {"boat": 49.0, "shop": 83.67}
    assert [tuple(r) for r in out.top_customers.collect()] == [(8, 251.0), (6, 107.0), (5, 40.0)]
    out.write(str(tmp_path / "joined"))
    assert sorted(d for d in os.listdir(tmp_path / "joined") if "=" in d) == ["city=Mull", "city=Skye"]
    assert spark.read.parquet(str(tmp_path / "joined")).count() == 6


def test_shared_etl_reads_each_table_once(spark, tmp_path, etl_tables):
    for name, df in zip(("orders", "customers"), etl_tables, strict=True):
        df.write.parquet(f"{tmp_path}/{name}")
    given = [spark.read.parquet(f"{tmp_path}/{n}") for n in ("orders", "customers")]
    plain = etl.order_etl(*given)
    with etl.shared_order_etl(*given) as shared:
        shared.joined.count()
        for name in ("sales_by_city", "average_by_segment", "top_customers"):
            assert bag(getattr(shared, name)) == bag(getattr(plain, name))
            plan = getattr(shared, name)._jdf.queryExecution().withCachedData().toString()
            assert "Relation" not in plan.replace("InMemoryRelation", "") or "InMemoryRelation" in plan


def test_min_pairs_counts_pairs_of_ratings(spark):
    rows = [(1, 10, 5), (1, 20, 3), (1, 20, 4), (1, 20, 2)]
    df = spark.createDataFrame(rows, "user int, item int, rating int")
    found = similarity.item_similarity(df, "user", "item", "rating", min_pairs=2)
    assert [(r.item1, r.item2, r.num_pairs) for r in found.collect()] == [(10, 20, 3)]


def test_lake_job_from_files_to_tables(spark, tmp_path):
    (tmp_path / "customers.csv").write_text(
        "customer_id,first_name,last_name,email,phone,signup_date,country,state,postal_code,is_active,loyalty_points\n"
        "1001, Ann ,Lee,a@b.co,555-123-4567,2024-01-02,U.S.A.,oh,45402,true,-5\n"
        "1001,Ann,Lee,a@b.co,555-123-4567,2024-01-02,U.S.A.,oh,45402,true,-5\n"
        "1002,Bob,Ray,a@b.co,555-123-4567,not a day,USA,oh,45402,true,5\n"
    )
    (tmp_path / "orders.csv").write_text(
        "order_id,customer_id,product_id,order_date,ship_date,quantity,unit_price,discount_pct,total_amount,payment_method,order_status\n"
        "100001,1001,P0001,2024-02-01,2024-02-03,-2,4.5,0.0,-9.0,card,shipped\n"
        "100002,1001,P0002,2024-02-01,,1,4.5,0.0,4.5,card,open\n"
    )
    (tmp_path / "products.csv").write_text(
        "product_id,product_name,category,brand,price,cost,stock_quantity,weight_kg,created_date,is_active\n"
        "P0001,Pen,office,Acme,4.5,-1.5,-7,0.1,2023-01-01,true\n"
        "BAD,Ink,office,Acme,4.5,1.5,7,0.1,2023-01-01,true\n"
    )
    sinks.ensure_database(spark, "shop")
    for name, schema, clean in (
        ("customers", etl.CUSTOMERS_SCHEMA, etl.clean_customers),
        ("orders", etl.ORDERS_SCHEMA, etl.clean_orders),
        ("products", etl.PRODUCTS_SCHEMA, etl.clean_products),
    ):
        raw = sources.read_csv(spark, str(tmp_path / f"{name}.csv"), schema)
        sinks.replace_table(clean(raw), f"shop.{name}")
    tables = [spark.table(f"shop.{n}") for n in ("customers", "orders", "products")]
    assert bag(tables[0], "first_name", "country", "state", "loyalty_points") == {
        ("Ann", "USA", "OH", 0): 1
    }
    assert bag(tables[1], "order_id", "quantity", "total_amount") == {("100001", 2, 9.0): 1}
    assert bag(tables[2], "product_id", "cost", "stock_quantity") == {("P0001", 1.5, 0): 1}
    assert bag(warehouse.who_bought_what(*tables)) == {("Ann", "Lee", "a@b.co", "Pen"): 1}
    sinks.drop_database(spark, "shop", cascade=True)


def test_spend_per_customer(spark):
    df = spark.createDataFrame([("a", 1.5), ("b", 4.0), ("a", 2.5), ("c", 9.0)], "c string, x double")
    spend = [tuple(r) for r in sales.spend_per_customer(df, "c", "x").collect()]
    assert spend == [("c", 9.0), ("a", 4.0), ("b", 4.0)]


def test_warehouse_queries(spark):
    customers = spark.createDataFrame(
        [("1", "Ann", "Lee", "a@b.co", "USA", 400), ("2", "Bob", "Ray", "b@b.co", "USA", 300),
         ("3", "Cy", "Fox", "c@b.co", "Peru", 301)],
        "customer_id string, first_name string, last_name string, email string, country string, loyalty_points int",
    )
    orders = spark.createDataFrame(
        [("1", "p", 10.0), ("1", "q", 30.0), ("2", "p", 50.0), ("9", "p", 1.0)],
        "customer_id string, product_id string, total_amount double",
    )
    products = spark.createDataFrame(
        [("p", "Pen", "office", 5), ("q", "Quill", "office", 7), ("r", "Rug", "home", 1)],
        "product_id string, product_name string, category string, stock_quantity int",
    )
    assert bag(warehouse.loyal_customers(customers), "first_name") == {("Ann",): 1, ("Cy",): 1}
    assert bag(warehouse.spend_by_customer(customers, orders)) == {
        ("Ann", "Lee", "USA", 40.0): 1, ("Bob", "Ray", "USA", 50.0): 1,
    }
    assert bag(warehouse.average_spend_by_country(customers, orders)) == {("USA", 30.0): 1}
    assert bag(warehouse.stock_by_category(products)) == {("office", 12): 1, ("home", 1): 1}
    assert bag(warehouse.who_bought_what(customers, orders, products)) == {
        ("Ann", "Lee", "a@b.co", "Pen"): 1, ("Ann", "Lee", "a@b.co", "Quill"): 1,
        ("Bob", "Ray", "b@b.co", "Pen"): 1,
    }
    assert spark.createDataFrame([], warehouse.PASSENGER_SCHEMA).count() == 0


# --- shape of the plans ------------------------------------------------------------

SF = "/root/testdata/sf0.001"


def plan_of(spark, name):
    from workload import QUERIES

    return final_plan(QUERIES[name](spark, SF))


@pytest.mark.parametrize("name", ["topk", "top_n_values", "bottom_n_values", "argmax", "etl_top3"])
def test_top_k_never_sorts_everything(spark, name):
    assert "TakeOrderedAndProject" in plan_of(spark, name)


@pytest.mark.parametrize("name", ["win_top_dense", "win_row_number", "win_rank"])
def test_groups_are_cut_before_the_shuffle(spark, name):
    plan = plan_of(spark, name)
    assert "Partial" in plan and plan.count("WindowGroupLimit") == 2


def test_sessions_use_one_shuffle_and_one_sort(spark):
    plan = plan_of(spark, "sessionize")
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def test_intersection_aggregates_before_its_only_shuffle(spark):
    plan = plan_of(spark, "set_intersect")
    assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(spark, "filter_gt")
    assert "GreaterThan(c_acctbal,5000.0)" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in plan


def test_partition_pruning(spark):
    assert "PartitionFilters: [isnotnull(c_mktsegment" in plan_of(spark, "sink_partitioned")


def test_similarity_scans_each_table_once(spark):
    # Looked at before adaptive execution drops the branch for large users.
    from workload import QUERIES

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = QUERIES["item_similarity"](spark, SF)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("FileScan") == 2 and "ReusedExchange" in plan


def plain_similarity(rows, min_pairs):
    """(item1, item2) -> (score, pairs) over all pairs of ratings by one user."""
    sums = defaultdict(lambda: [0, 0, 0, 0])
    for user, a, x in rows:
        for other, b, y in rows:
            if user is not None and user == other and a is not None and b is not None and a < b:
                s = sums[a, b]
                for i, v in enumerate((x * y, x * x, y * y, 1)):
                    s[i] += v
    return {p: (s[0] / (math.sqrt(s[1]) * math.sqrt(s[2])), s[3]) for p, s in sums.items() if s[3] >= min_pairs}


@pytest.mark.parametrize("rounds", [1, 2, 4])
@pytest.mark.parametrize("min_pairs", [2, 4, 9])
def test_pruned_similarity_loses_no_pair(spark, min_pairs, rounds):
    """Ratings that repeat, users with one item, items of few users, users and items that are NULL."""
    rng = random.Random(min_pairs)
    rows = [(rng.choice([*range(12), *range(60)]), rng.choice([*range(6), *range(80)]), rng.randint(1, 5)) for _ in range(420)]
    rows += [(99, 70, 3)] * 3 + [(99, 71, 2)] * 3 + [(None, 1, 2), (3, None, 2)]
    df = spark.createDataFrame(rows, "u int, i int, r int")
    found = similarity.item_similarity(df, "u", "i", "r", min_pairs=min_pairs, rounds=rounds).collect()
    expected = plain_similarity(rows, min_pairs)
    assert {(f.item1, f.item2): (pytest.approx(f.score), f.num_pairs) for f in found} == expected and expected


def test_pruning_forms_fewer_pairs(spark):
    """Many items with few ratings beside some with many: what is left forms a small part of all pairs."""
    rare = [(u, 1000 + 40 * u + i, 3) for u in range(50) for i in range(40)]
    often = [(u, i, 1 + (u + i) % 5) for u in range(50) for i in range(6)]
    df = spark.createDataFrame(rare + often, "u int, i int, r int")
    left = similarity.could_reach(df, "u", "i", 20)
    assert bag(left) == bag(spark.createDataFrame(often, "u int, i int, r int"))
    formed = lambda rows: joins.pairs(rows, "u", "i").count()
    assert formed(left) * 50 < formed(df)
    same = similarity.item_similarity(df, "u", "i", "r", min_pairs=20)
    assert bag(same) == bag(similarity.item_similarity(df, "u", "i", "r").where("num_pairs >= 20"))
    # A pair with as many pairs of ratings as asked for by one user alone stays.
    one = spark.createDataFrame([(1, 1, 2)] * 5 + [(1, 2, 3)] * 4, "u int, i int, r int")
    assert [r.num_pairs for r in similarity.item_similarity(one, "u", "i", "r", min_pairs=20).collect()] == [20]
