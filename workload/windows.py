"""Window operators over customers, daily transactions and raw events."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe.operators import windows
from loomframe.plans.sessions import sessionize as sessions_of
from workload.registry import Tables, query

# Amounts are kept in whole cents, so that sums and differences are exact.
DAILY_SQL = """
    daily AS (
        SELECT user_id, CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS day,
            CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
        FROM events GROUP BY 1, 2
    )
"""


def daily_transactions(t: Tables):
    """One row per user and day: a group is never longer than the calendar."""
    day = F.datediff("ts", F.lit("1970-01-01").cast("date")).alias("day")
    return t.events.groupBy("user_id", day).agg(
        F.sum(F.rint(F.col("value") * 100).cast("long")).alias("cents")
    )


def _top_sql(function: str, order: str, n: int) -> str:
    return f"""
        SELECT c_nationkey, c_custkey, c_acctbal, CAST(rank AS INTEGER) AS rank FROM (
            SELECT *, {function}() OVER (PARTITION BY c_nationkey ORDER BY {order}) AS rank
            FROM customer)
        WHERE rank <= {n}
    """


TENS_SQL = "floor(c_acctbal / 1000) DESC"
COLS = ["c_nationkey", "c_custkey", "c_acctbal", "rank"]


@query(_top_sql("dense_rank", TENS_SQL, 1))
def win_top_dense(t: Tables):
    order = [F.desc(F.floor(F.col("c_acctbal") / 1000))]
    return windows.top_per_group(t.customer, "c_nationkey", order).select(*COLS)


@query(_top_sql("row_number", "c_acctbal DESC, c_custkey", 5))
def win_row_number(t: Tables):
    order = [F.desc("c_acctbal"), F.asc("c_custkey")]
    top = windows.top_per_group(t.customer, "c_nationkey", order, 5, ties="none")
    return top.select(*COLS)


@query(_top_sql("rank", TENS_SQL, 5))
def win_rank(t: Tables):
    order = [F.desc(F.floor(F.col("c_acctbal") / 1000))]
    return windows.top_per_group(t.customer, "c_nationkey", order, 5, ties="gap").select(*COLS)


@query(
    f"""
    WITH {DAILY_SQL} SELECT user_id, day, cents, CAST(sum(cents) OVER (PARTITION BY user_id ORDER BY day
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_total
    FROM daily
    """
)
def win_running_sum(t: Tables):
    return windows.running_sum(daily_transactions(t), "user_id", ["day"], "cents")


LAG_SQL = "lag(cents) OVER (PARTITION BY user_id ORDER BY day)"


@query(f"WITH {DAILY_SQL} SELECT user_id, day, cents, {LAG_SQL} AS previous FROM daily")
def win_lag(t: Tables):
    return windows.previous(daily_transactions(t), "user_id", ["day"], "cents")


@query(f"WITH {DAILY_SQL} SELECT user_id, day, cents, cents - {LAG_SQL} AS difference FROM daily")
def win_delta(t: Tables):
    return windows.delta(daily_transactions(t), "user_id", ["day"], "cents")


@query(
    f"""
    WITH {DAILY_SQL} SELECT user_id, day, cents, round(avg(cents) OVER (PARTITION BY user_id ORDER BY day
        RANGE BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS rolling_average
    FROM daily
    """
)
def win_rolling_range(t: Tables):
    rolling = windows.rolling_mean(daily_transactions(t), "user_id", "day", "cents")
    return rolling.withColumn("rolling_average", F.round("rolling_average", 6))


@query(
    """
    WITH flagged AS (
        SELECT event_id, user_id, ts, CASE WHEN floor(epoch(ts)) - floor(epoch(
            lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) > 1800 THEN 1 ELSE 0 END AS fresh
        FROM events
    )
    SELECT event_id, user_id, CAST(sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id
        ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_id
    FROM flagged
    """
)
def sessionize(t: Tables):
    events = t.events.select("event_id", "user_id", "ts")
    return sessions_of(events, "user_id", "ts", tiebreak="event_id").drop("ts")


# A third of the events belong to one user, one of them with a time far from all others.
HOT_EVENTS_SQL = """
    hot_events AS (
        SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id,
            CASE WHEN event_id = 3 THEN TIMESTAMP '1971-01-01 00:00:00' ELSE CAST(ts AS TIMESTAMP) END AS ts,
            CAST(round(value * 100) AS BIGINT) AS cents
        FROM events
    )
"""
#: Low limits, so that the small tables have hot users too.
HOT = {"share": 0.05, "min_rows": 100}


def hot_events(t: Tables):
    user = F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id"))
    early = F.lit("1971-01-01 00:00:00").cast(t.events.schema["ts"].dataType)
    ts = F.when(F.col("event_id") == 3, early).otherwise(F.col("ts"))
    cents = F.rint(F.col("value") * 100).cast("long")
    return t.events.select("event_id", user.alias("user_id"), ts.alias("ts"), cents.alias("cents"))


HOT_WINDOW = "OVER (PARTITION BY user_id ORDER BY ts, event_id"


@query(
    f"""
    WITH {HOT_EVENTS_SQL}, flagged AS (
        SELECT event_id, user_id, ts, CASE WHEN floor(epoch(ts)) - floor(epoch(lag(ts) {HOT_WINDOW}))) > 1800
            THEN 1 ELSE 0 END AS fresh
        FROM hot_events
    )
    SELECT event_id, user_id, CAST(sum(fresh) {HOT_WINDOW} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_id
    FROM flagged
    """
)
def sessionize_hot(t: Tables):
    events = hot_events(t).select("event_id", "user_id", "ts")
    return sessions_of(events, "user_id", "ts", tiebreak="event_id", **HOT).drop("ts")


@query(
    f"""
    WITH {HOT_EVENTS_SQL} SELECT event_id, user_id,
        CAST(sum(cents) {HOT_WINDOW} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_total
    FROM hot_events
    """
)
def win_running_sum_hot(t: Tables):
    sliced = windows.slice_hot(hot_events(t), "user_id", "ts", **HOT)
    summed = windows.running_sum(sliced, "user_id", ["ts", "event_id"], "cents", slice="slice")
    return summed.select("event_id", "user_id", "running_total")


@query(f"WITH {HOT_EVENTS_SQL} SELECT event_id, user_id, lag(cents) {HOT_WINDOW}) AS previous FROM hot_events")
def win_lag_hot(t: Tables):
    sliced = windows.slice_hot(hot_events(t), "user_id", "ts", **HOT)
    found = windows.previous(sliced, "user_id", ["ts", "event_id"], "cents", slice="slice")
    return found.select("event_id", "user_id", "previous")


DAY_OF_EVENT_SQL = "CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER)"


@query(
    f"""
    WITH {HOT_EVENTS_SQL}, dated AS (SELECT event_id, user_id, {DAY_OF_EVENT_SQL} AS day, cents FROM hot_events)
    SELECT event_id, user_id, day, round(avg(cents) OVER (PARTITION BY user_id ORDER BY day
        RANGE BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS rolling_average,
        max(cents) OVER (PARTITION BY user_id ORDER BY day RANGE BETWEEN 6 PRECEDING AND CURRENT ROW) AS largest
    FROM dated
    """
)
def win_rolling_range_hot(t: Tables):
    day = F.datediff("ts", F.lit("1970-01-01").cast("date")).alias("day")
    dated = hot_events(t).select("event_id", "user_id", day, "cents")
    sliced = windows.slice_hot(dated, "user_id", "day", **HOT)
    rolled = windows.rolling_mean(sliced, "user_id", "day", "cents", slice="slice")
    rolled = windows.rolling(rolled, "user_id", "day", F.max("cents"), "largest", slice="slice")
    return rolled.select("event_id", "user_id", "day", F.round("rolling_average", 6).alias("rolling_average"), "largest")


@query(
    """
    SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place,
        rank() OVER (ORDER BY o_orderdate) AS day_rank, dense_rank() OVER (ORDER BY o_orderdate) AS day_number
    FROM orders
    """
)
def win_global_rank(t: Tables):
    orders = t.orders.select("o_orderkey", "o_totalprice", "o_orderdate")
    placed = windows.global_rank(orders, {"o_totalprice": "desc", "o_orderkey": "asc"}, name="place")
    ranked = windows.global_rank(placed, {"o_orderdate": "asc"}, ties="gap", name="day_rank")
    numbered = windows.global_rank(ranked, {"o_orderdate": "asc"}, ties="dense", name="day_number")
    return numbered.select("o_orderkey", "place", "day_rank", "day_number")
