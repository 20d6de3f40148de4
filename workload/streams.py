"""Jobs over streams: events arrive in two parts and a heartbeat, each taken in by a run of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe import sinks, streaming
from workload.logs import STATUS_SQL, _status
from workload.registry import Tables, query


def _arrivals(events: DataFrame, ts: str) -> list[DataFrame]:
    """The first half of the time with some rows of the half hour after it, the rest, and a row a day after all that has a time alone."""
    first, last = F.unix_micros(F.min(F.col(ts).cast("timestamp"))), F.unix_micros(F.max(F.col(ts).cast("timestamp")))
    middle = events.agg(F.floor((first + last) / 2)).scalar()
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    early = (micros < middle) | ((micros < middle + 1_800_000_000) & (F.xxhash64(*events.columns) % 2 == 0))
    kinds = dict(events.dtypes)
    nothing = [F.lit(None).cast(kinds[c]).alias(c) for c in events.columns if c != ts]
    heartbeat = events.agg((F.max(ts) + F.expr("INTERVAL 1 DAY")).cast(kinds[ts]).alias(ts)).select(ts, *nothing)
    return [events.where(early), events.where(~early), heartbeat.select(*events.columns)]


def _run_by_run(t: Tables, events: DataFrame, ts: str, job, name: str) -> DataFrame:
    """What ``job`` makes of the stream after all arrivals; every run goes on from the one before."""
    source, out, checkpoint = (sinks.scratch_dir(t.spark, f"{name}-{part}") for part in ("in", "out", "state"))
    for part in _arrivals(events, ts):
        part.write.mode("append").parquet(source)
        streaming.drained(job(streaming.follow_files(t.spark, source, events.schema)), out, checkpoint)
    return t.spark.read.parquet(out)


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
def stream_sessions(t: Tables):
    events = t.events.select("event_id", "user_id", "ts")
    numbered = _run_by_run(
        t, events, "ts", lambda s: streaming.stream_sessions(s, "user_id", "ts", tiebreak="event_id"), "sessions"
    )
    return numbered.select("event_id", "user_id", "session_id")


def _timed_lines(t: Tables) -> DataFrame:
    """Access-log lines with their time."""
    parts = ["user_id", F.lit('- - [t z] "GET'), F.concat(F.lit("/"), "event_type"), F.lit('HTTP/1.1"'), _status(), F.lit("12")]
    return t.events.select(F.col("ts").cast("timestamp").alias("ts"), F.concat_ws(" ", *parts).alias("value"))


@query("SELECT '/' || event_type AS endpoint, count(*) AS n FROM events GROUP BY 1")
def stream_log_counts(t: Tables):
    windows = _run_by_run(
        t, _timed_lines(t), "ts", lambda s: streaming.windowed_counts(streaming.access_events(s), "endpoint"), "endpoints"
    )
    # The heartbeat is a line without fields.
    return streaming.counts_so_far(windows.where("endpoint is not null"), "endpoint")


@query(
    f"""
    SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start, {STATUS_SQL} AS status, count(*) AS n FROM events GROUP BY 1, 2
    """
)
def stream_status_by_hour(t: Tables):
    windows = _run_by_run(
        t, _timed_lines(t), "ts", lambda s: streaming.windowed_counts(streaming.access_events(s), "status"), "status"
    )
    return windows.where("status is not null").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
