"""Log analytics over lines built from the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe.plans import logs
from workload.registry import Tables, query

STATUS_SQL = "CASE WHEN event_type = 'error' THEN '500' ELSE '200' END"
LEVEL_SQL = """CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN'
    WHEN 'view' THEN 'DEBUG' ELSE 'INFO' END"""


def _status():
    return F.when(F.col("event_type") == "error", "500").otherwise("200")


def _access_lines(t: Tables):
    """``user - - [t z] "GET /type HTTP/1.1" status bytes``, the last two missing in some."""
    head = [
        F.col("user_id").cast("string"),
        F.lit('- - [t z] "GET'),
        F.concat(F.lit("/"), "event_type"),
        F.lit('HTTP/1.1"'),
    ]
    whole = F.concat_ws(" ", *head, _status(), F.floor(F.col("value") * 100).cast("string"))
    return t.events.select(
        F.when(F.col("event_id") % 13 == 0, F.concat_ws(" ", *head)).otherwise(whole).alias("value")
    )


@query("SELECT CAST(user_id AS VARCHAR) AS IP_address, count(*) AS request_count FROM events GROUP BY 1")
def log_by_ip(t: Tables):
    return logs.log_counts(_access_lines(t), "IP_address", "request_count")


@query("SELECT '/' || event_type AS endpoint, count(*) AS endpoint_count FROM events GROUP BY 1")
def log_by_endpoint(t: Tables):
    return logs.log_counts(_access_lines(t), "endpoint", "endpoint_count")


@query(
    f"""
    SELECT CASE WHEN event_id % 13 <> 0 THEN {STATUS_SQL} END AS status, count(*) AS status_count
    FROM events GROUP BY 1
    """
)
def log_by_status(t: Tables):
    return logs.log_counts(_access_lines(t), "status", "status_count")


@query("SELECT '/' || event_type AS endpoint, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY 1")
def weblog_endpoint_counts(t: Tables):
    path = F.concat(F.lit("/"), "event_type")
    line = F.concat_ws(" ", "user_id", F.lit("GET"), path, _status(), F.lit("1ms"))
    return logs.endpoint_counts(t.events.select(line.alias("value")))


def _app_lines(t: Tables):
    """``date time LEVEL text`` with runs of spaces inside."""
    kind = F.col("event_type")
    level = (
        F.when(kind == "error", "ERROR")
        .when(kind == "signup", "WARN")
        .when(kind == "view", "DEBUG")
        .otherwise("INFO")
    )
    clock = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    text = F.concat(F.lit("user  "), F.col("user_id").cast("string"), F.lit(" failed "))
    return t.events.select(F.concat_ws(" ", clock, level, text).alias("value"))


APP_WORDS_SQL = """
    SELECT unnest([strftime(ts, '%Y-%m-%d'), strftime(ts, '%H:%M:%S'), 'ERROR', 'USER',
        CAST(user_id AS VARCHAR), 'FAILED']) AS word
    FROM events WHERE event_type = 'error'
"""


@query(APP_WORDS_SQL)
def log_error_words(t: Tables):
    return logs.error_words(_app_lines(t))


@query(f"SELECT {LEVEL_SQL} AS level FROM events")
def log_levels(t: Tables):
    return logs.log_levels(_app_lines(t))


@query("SELECT 'user ' || user_id || ' failed' AS message FROM events WHERE event_type = 'error'")
def log_error_messages(t: Tables):
    return logs.error_messages(_app_lines(t))
