from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from conftest import bag, final_plan
from pyspark.sql import functions as F

from loomframe.operators import windows
from loomframe.plans.sessions import sessionize


@pytest.fixture
def transactions(spark):
    # Water drawn from a cistern, with two days without a reading.
    readings = [(3, 40), (4, 0), (6, 12), (7, 90), (8, 3), (9, 3), (12, 61)]
    rows = [("cistern", day, litres) for day, litres in readings]
    return spark.createDataFrame(rows, "user string, date int, amount long")


def by_date(df, col):
    return [r[0] for r in df.orderBy("date").select(col).collect()]


def test_running_previous_delta_rolling(transactions):
    running = windows.running_sum(transactions, "user", ["date"], "amount")
    assert by_date(running, "running_total") == [40, 40, 52, 142, 145, 148, 209]
    previous = windows.previous(transactions, "user", ["date"], "amount")
    assert by_date(previous, "previous") == [None, 40, 0, 12, 90, 3, 3]
    delta = windows.delta(transactions, "user", ["date"], "amount")
    assert by_date(delta, "difference") == [None, -40, 12, 78, -87, 0, 58]
    rolling = windows.rolling_mean(transactions, "user", "date", "amount")
    assert [round(v, 4) for v in by_date(rolling, "rolling_average")] == [
        40, 20, 17.3333, 35.5, 29, 24.6667, 33.8,
    ]


def test_rolling_mean_counts_days_not_rows(spark):
    rows = [("A", 1, 10), ("A", 1, 30), ("A", 9, 5), ("A", 10, None), (None, 1, 2), (None, 3, 4)]
    df = spark.createDataFrame(rows, "u string, d int, v long")
    rolled = windows.rolling_mean(df, "u", "d", "v")
    assert bag(rolled, "u", "d", "rolling_average") == {
        ("A", 1, 20.0): 2, ("A", 9, 5.0): 1, ("A", 10, 5.0): 1, (None, 1, 2.0): 1, (None, 3, 3.0): 1,
    }


WATERS = [
    ("river", "Oder", 840), ("river", "Weser", 451), ("river", "Elbe", 1094), ("river", "Aare", 1094),
    ("lake", "Bled", 2), ("lake", "Ohrid", 30), ("lake", "Como", 46),
]


@pytest.mark.parametrize(
    ("ties", "n", "expected"),
    [
        ("dense", 1, {"Elbe", "Aare", "Como"}),
        ("dense", 2, {"Elbe", "Aare", "Oder", "Como", "Ohrid"}),
        ("gap", 2, {"Elbe", "Aare", "Como", "Ohrid"}),
        ("none", 1, {"Aare", "Como"}),
    ],
)
def test_top_per_group(spark, ties, n, expected):
    df = spark.createDataFrame(WATERS, "kind string, name string, length int")
    order = [F.desc("length")] + ([F.asc("name")] if ties == "none" else [])
    top = windows.top_per_group(df, "kind", order, n, ties)
    assert {r.name for r in top.collect()} == expected


def sessions_by_hand(rows, gap=1800):
    """(id, session) from (user, ts, id), one user at a time."""
    users = defaultdict(list)
    for user, ts, ident in rows:
        users[user].append((ts, ident))
    out = {}
    for events in users.values():
        session, before = 0, None
        for ts, ident in sorted(events):
            whole = ts.replace(microsecond=0)
            if before is not None and (whole - before).total_seconds() > gap:
                session += 1
            out[ident] = session
            before = whole
    return out


NOON = datetime(2026, 7, 9, 12)


def test_sessions(spark):
    times = ["08:59:30", "12:01:00", "12:31:00", "13:01:01", "13:01:01", "17:45:10", "18:00:00"]
    rows = [(1, datetime.fromisoformat(f"2026-07-09 {t}")) for t in times]
    df = spark.createDataFrame(rows, "user int, ts timestamp")
    found = [r[0] for r in sessionize(df, "user", "ts").orderBy("ts").select("session_id").collect()]
    assert found == [0, 1, 1, 2, 2, 3, 3]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_gap_has_to_be_longer_than_the_limit(spark, kind):
    seconds = [0, 1800, 3601, 5401.5, 7201.4]
    rows = [(1, NOON + timedelta(seconds=s)) for s in seconds]
    df = spark.createDataFrame(rows, f"user int, ts {kind}")
    found = [r[0] for r in sessionize(df, "user", "ts").orderBy("ts").select("session_id").collect()]
    assert found == [0, 0, 1, 1, 1]


def skewed_events(seed):
    """Half of the events belong to one user and a sixth to nobody."""
    rng = random.Random(seed)
    rows = []
    for i in range(600):
        user = 1 if i % 2 else rng.choice([None, 2, 3, 4, 5, 6])
        rows.append((user, NOON + timedelta(seconds=rng.randrange(0, 400_000)), i))
    return rows


HOT = {"share": 0.05, "min_rows": 20}


@pytest.mark.parametrize("seed", range(3))
def test_sessions_of_hot_users_equal_brute_force(spark, seed):
    rows = skewed_events(seed)
    df = spark.createDataFrame(rows, "user int, ts timestamp_ntz, id int").repartition(3)
    sliced = windows.slice_hot(df, "user", "ts", **HOT)
    assert sliced.where("user = 1").select("slice").distinct().count() > 200
    assert sliced.where("user IS NULL AND slice > 0").count() > 0
    found = sessionize(df, "user", "ts", tiebreak="id", **HOT)
    assert {r.id: r.session_id for r in found.collect()} == sessions_by_hand(rows)


def test_sliced_windows_equal_plain_windows(spark):
    rng = random.Random(1)
    rows = [
        (rng.choice([1, 1, 1, 2, None]), rng.choice([None, *range(80)]), i, rng.choice([None, *range(9)]))
        for i in range(500)
    ]
    df = spark.createDataFrame(rows, "u int, at int, id int, v int")
    sliced = windows.slice_hot(df, "u", "at", **HOT)
    assert sliced.where("slice > 0").count() > 200
    for fn in (windows.previous, windows.running_sum, windows.delta):
        plain = fn(df, "u", ["at", "id"], "v", "out")
        cut = fn(sliced, "u", ["at", "id"], "v", "out", slice="slice")
        assert bag(cut, "id", "out") == bag(plain, "id", "out"), fn.__name__


def test_slices_follow_the_order_for_every_type(spark):
    rows = [(1, NOON + timedelta(hours=7 * i), i) for i in range(200)]
    df = spark.createDataFrame(rows, "u int, ts timestamp_ntz, id int").withColumns(
        {"day": F.col("ts").cast("date"), "zoned": F.col("ts").cast("timestamp"), "x": F.col("id") / 3}
    )
    for col in ("ts", "day", "zoned", "x", "id"):
        sliced = windows.slice_hot(df, "u", col, **HOT).orderBy("id")
        numbers = [r.slice for r in sliced.select("slice").collect()]
        assert numbers == sorted(numbers) and numbers[0] == 1 and numbers[-1] > 180, col


def test_slices_hold_equal_parts_despite_an_outlier(spark):
    rows = spark.range(40_000).select(
        F.lit(1).alias("u"), F.when(F.col("id") == 7, -10**12).otherwise(F.col("id") + 1_700_000_000).alias("at")
    )
    sliced = windows.slice_hot(rows, "u", "at", share=0.5, min_rows=100)
    sizes = [r["count"] for r in sliced.groupBy("slice").count().collect()]
    assert len(sizes) >= 250 and max(sizes) <= 2 * 40_000 / 256


def test_one_search_serves_several_operators(spark):
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, 1, id) AS u", "id AS at", "id % 5 AS v")
    cuts = windows.hot_cuts(rows, "u", "at", share=0.1, min_rows=10)
    a, b = (windows.slice_hot(rows, "u", "at", hot=cuts), windows.slice_hot(rows, "u", "at", share=0.1, min_rows=10))
    assert bag(a) == bag(b)
    with pytest.raises(ValueError, match="share"):
        windows.hot_cuts(rows, "u", "at", share=1e-6)


def test_rolling_mean_is_one_shuffle_and_equals_the_form_by_day(spark):
    rows = spark.range(500).selectExpr("id % 7 AS u", "cast(pmod(id * 37, 61) AS int) AS d", "id % 11 AS v")
    one = windows.rolling_mean(rows, "u", "d", "v", name="m")
    assert one._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    two = windows.rolling_mean_by_day(rows, "u", "d", "v", name="m")
    assert bag(one.withColumn("m", F.round("m", 9))) == bag(two.withColumn("m", F.round("m", 9)))


def rolled_by_hand(rows, days, fold):
    """(group, day, folded values) of each row."""
    out = defaultdict(int)
    for group, day, _ in rows:
        recent = [v for g, d, v in rows if g == group and day - days < d <= day and v is not None]
        out[(group, day, fold(recent) if recent else None)] += 1
    return out


@pytest.mark.parametrize("span", [12, 400])
def test_rolling_over_slices_equals_one_window(spark, span):
    # Slices of a day or less, and slices of many days; days are missing and repeat.
    rng = random.Random(span)
    rows = [("hot", rng.randrange(span), rng.choice([None, *range(9)])) for _ in range(900)]
    rows += [(u, rng.randrange(span), rng.randrange(9)) for u in ("a", None, "b") for _ in range(25)]
    df = spark.createDataFrame(rows, "u string, d int, v long")
    sliced = windows.slice_hot(df, "u", "d", share=0.2, min_rows=100)
    assert sliced.where("slice > 0").select("slice").distinct().count() > 8
    mean = windows.rolling_mean(sliced, "u", "d", "v", days=5, slice="slice")
    assert bag(mean, "u", "d", "rolling_average") == rolled_by_hand(rows, 5, lambda v: sum(v) / len(v))
    largest = windows.rolling(sliced, "u", "d", F.max("v"), "m", days=3, slice="slice")
    assert bag(largest, "u", "d", "m") == rolled_by_hand(rows, 3, max)


def test_no_window_gets_more_than_a_slice_and_its_overlap(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("u"), (F.col("id") % 1000).cast("int").alias("d"), "id")
    sliced = windows.slice_hot(df, "u", "d", share=0.2, min_rows=100)
    placed = windows.with_overlap(sliced, "u", "d", 7, "slice").groupBy("u", "_slice").count()
    # Twenty rows a day; a slice has about four days.
    assert placed.agg(F.max("count")).first()[0] <= 20 * (12 + 6)


@pytest.mark.parametrize("ties", ["dense", "gap", "none"])
def test_global_rank_equals_one_window(spark, ties):
    rng = random.Random(7)
    rows = [(rng.choice([None, 5, 5, 5, *range(40)]), rng.choice("ab"), i) for i in range(600)]
    df = spark.createDataFrame(rows, "v int, s string, rank int").repartition(5)
    order = {"v": "desc", "s": "asc"} | ({"rank": "asc"} if ties == "none" else {})
    key = lambda r: (-(r[0] if r[0] is not None else -1), r[1], *([r[2]] if ties == "none" else []))
    keys = sorted(key(r) for r in rows)
    places = {"gap": lambda k: keys.index(k) + 1, "none": lambda k: keys.index(k) + 1, "dense": lambda k: sorted(set(keys)).index(k) + 1}
    ranked = windows.global_rank(df, order, ties, "place")
    assert ranked.columns == ["v", "s", "rank", "place"]
    assert bag(ranked) == {(*r, places[ties](key(r))): 1 for r in rows}
    # Every window works inside ranges.
    plan = final_plan(ranked)
    assert plan.count("windowspecdefinition(") == plan.count("windowspecdefinition(_range") > 0


def test_global_rank_numbers_copies_and_empty_tables(spark):
    df = spark.range(0, 3000, 1, 6).select(F.when(F.col("id") < 1000, 1).otherwise(F.col("id")).alias("v"))
    numbered = windows.global_rank(df, {"v": "asc"})
    assert sorted(r.rank for r in numbered.collect()) == list(range(1, 3001))
    assert numbered.where("v = 1").agg(F.max("rank")).first()[0] == 1000
    assert windows.global_rank(df.limit(0), {"v": "asc"}).count() == 0
    assert windows.global_rank(df.limit(0), {"v": "asc"}, "gap").count() == 0
    with pytest.raises(ValueError, match="ties"):
        windows.global_rank(df, {"v": "asc"}, "some")
