from __future__ import annotations

import os
import random
from datetime import datetime, timedelta

import pytest
from conftest import bag
from pyspark.sql import functions as F

from loomframe import streaming
from loomframe.plans.sessions import sessionize

NOON = datetime(2026, 7, 9, 12)


def at(minutes: float) -> datetime:
    return NOON + timedelta(minutes=minutes)


class Folder:
    """Files that arrive one after the other, and a job that takes in what has come."""

    def __init__(self, spark, path, schema, job):
        self.spark, self.path, self.schema, self.job = spark, str(path), schema, job

    def arrive(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(f"{self.path}/in")

    def run(self):
        stream = streaming.follow_files(self.spark, f"{self.path}/in", self.schema)
        streaming.drained(self.job(stream), f"{self.path}/out", f"{self.path}/state")
        return self.spark.read.parquet(f"{self.path}/out")


EVENTS = "user string, id long, ts timestamp, note string"


@pytest.fixture
def sessions(spark, tmp_path):
    return Folder(spark, tmp_path, EVENTS, lambda s: streaming.stream_sessions(s, "user", "ts", tiebreak="id", delay="20 minutes"))


def test_events_leave_in_order_once_time_has_passed(spark, sessions):
    first = [("a", 1, at(0), "x"), ("a", 2, at(10), "x"), ("b", 3, at(5), None), ("a", 4, at(45), "x"), (None, 5, at(1), "x")]
    sessions.arrive(first)
    # The newest time is 45, so all up to 25 leaves.
    assert bag(sessions.run(), "user", "id", "session_id") == {("a", 1, 0): 1, ("a", 2, 0): 1, ("b", 3, 0): 1, (None, 5, 0): 1}
    # Between what has left and what waits; the gap from 10 to 45 is bridged, so no session begins at 45.
    second = [("a", 6, at(30), "x"), ("a", 7, at(76), "x"), ("b", 8, at(36), "y"), ("a", 9, at(45), "x"), ("b", 10, None, "no time")]
    sessions.arrive(second)
    sessions.run()
    sessions.arrive([(None, None, at(1000), None)])
    rows = [r for r in first + second if r[2] is not None]
    batch = sessionize(spark.createDataFrame(rows, EVENTS), "user", "ts", tiebreak="id")
    made = sessions.run()
    assert made.columns == batch.columns and bag(made) == bag(batch)
    assert made.where("id = 7").first().session_id == 1


def test_late_events_are_dropped(sessions):
    sessions.arrive([("a", 1, at(0), "x"), ("a", 2, at(60), "x")])
    sessions.run()
    # Time stands at 40: 39 is too late, 41 is not.
    sessions.arrive([("a", 3, at(39), "x"), ("a", 4, at(41), "x"), ("new", 5, at(3), "x")])
    sessions.run()
    sessions.arrive([(None, None, at(1000), None)])
    assert bag(sessions.run(), "id", "session_id") == {(1, 0): 1, (2, 1): 1, (4, 1): 1}


def test_a_run_without_news_and_a_repeated_one_change_nothing(sessions):
    sessions.arrive([("a", i, at(i), "x") for i in range(50)])
    once = bag(sessions.run())
    assert bag(sessions.run()) == once and len(once) == 30


def test_a_batch_that_was_broken_off_is_repeated(spark, sessions):
    sessions.arrive([("a", 1, at(0), "x"), ("a", 2, at(60), "x")])
    sessions.run()
    sessions.arrive([("a", 3, at(70), "x"), ("a", 4, at(200), "x")])
    expected = bag(sessions.run())
    # As if the driver had died before it could note that the last batch was done.
    commits = f"{sessions.path}/state/commits"
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")
    assert bag(sessions.run()) == expected


def test_large_ids_stay_exact_beside_nulls(sessions):
    big = (1 << 60) + 1
    sessions.arrive([("a", big, at(0), "x"), ("a", None, at(1), "x"), ("a", big + 2, at(2), "x"), (None, None, at(500), None)])
    assert bag(sessions.run(), "id") == {(big,): 1, (None,): 1, (big + 2,): 1}


@pytest.mark.parametrize("kind", ["long", "string", "double"])
@pytest.mark.parametrize("buckets", [1, 3])
def test_users_that_share_a_bucket_keep_their_own_sessions(spark, tmp_path, kind, buckets):
    """Many users per bucket, in three runs, with NULL users, and NULL and large numbers that break ties."""
    rng, big, schema = random.Random(buckets), 1 << 60, f"user {kind}, id long, ts timestamp, note string"
    rows = [(rng.choice([None, *range(9)]), rng.choice([None, big + i]), at(rng.randrange(600)), f"n{i}") for i in range(150)]
    # Ties that a double could not tell apart, beside a NULL of another user.
    rows += [(1, big + i, at(700), "tie") for i in range(1, 30)] + [(2, None, at(700), "none"), (None, big, at(701), "null user")]
    rows = [(None if u is None else {"long": int, "string": str, "double": float}[kind](u), *rest) for u, *rest in rows]
    job = lambda s: streaming.stream_sessions(s, "user", "ts", tiebreak="id", delay="20 minutes", buckets=buckets)
    folder = Folder(spark, tmp_path, schema, job)
    rows.sort(key=lambda r: r[2])
    for part in (rows[:70], rows[70:], [(None, None, at(2000), None)]):
        folder.arrive(part)
        made = folder.run()
    rows = [r for r in rows if r[0] is not None or r[1] is not None]
    assert bag(made) == bag(sessionize(spark.createDataFrame(rows, schema), "user", "ts", tiebreak="id"))


def test_a_call_numbers_the_users_of_a_bucket(spark, tmp_path):
    """500 users in two buckets are two calls, and as many states."""
    rows = [(f"u{i}", i, at(0), "x") for i in range(500)]
    folder = Folder(spark, tmp_path, EVENTS, lambda s: streaming.stream_sessions(s, "user", "ts", tiebreak="id", buckets=2))
    folder.arrive(rows)
    folder.run()
    folder.arrive([(None, None, at(2000), None)])
    assert folder.run().count() == 500
    states = spark.read.format("statestore").load(f"{tmp_path}/state")
    # The bucket of the NULL user, whose heartbeat is no event, is one of them or has none.
    assert states.count() == 2


LINES = "ts timestamp, value string"


def line(endpoint: str, status: str = "200") -> str:
    return f'10.0.0.1 - - [t z] "GET {endpoint} HTTP/1.1" {status} 12'


def test_windows_of_log_lines_come_out_once(spark, tmp_path):
    job = lambda s: streaming.windowed_counts(streaming.access_events(s), "endpoint", window="10 minutes", delay="5 minutes")
    logs = Folder(spark, tmp_path, LINES, job)
    logs.arrive([(at(1), line("/a")), (at(2), line("/a")), (at(3), line("/b")), (at(11), line("/a")), (at(16), line("/a"))])
    assert bag(logs.run(), "endpoint", "n") == {("/a", 2): 1, ("/b", 1): 1}
    # The first window is closed; the second still takes rows.
    logs.arrive([(at(4), line("/late")), (at(12), line("/b")), (at(13), "short")])
    logs.run()
    logs.arrive([(at(900), None)])
    windows = logs.run()
    ten = F.date_format("window_start", "mm")
    assert bag(windows.select(ten, "endpoint", "n")) == {
        ("00", "/a", 2): 1, ("00", "/b", 1): 1, ("10", "/a", 2): 1, ("10", "/b", 1): 1, ("10", None, 1): 1,
    }
    assert bag(streaming.counts_so_far(windows, "endpoint")) == {("/a", 4): 1, ("/b", 2): 1, (None, 1): 1}


def test_one_file_a_batch(spark, tmp_path):
    for i in range(3):
        spark.createDataFrame([(at(i), line(f"/{i}"))], LINES).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = streaming.follow_files(spark, f"{tmp_path}/in", LINES, files=1)
    streaming.drained(stream, f"{tmp_path}/out", f"{tmp_path}/state")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3
    assert len([f for f in os.listdir(f"{tmp_path}/state/commits") if f.isdigit()]) == 3
