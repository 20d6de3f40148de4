"""Web and application logs held as text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.functions.text import grep, rest_of_line, split_columns, token, words

# Field names of an access-log line. Fixed values.
ACCESS_FIELDS = [
    "IP_address", "field1", "field2", "field3", "field4",
    "field5", "endpoint", "field7", "status", "field9",
]


def _ranked(counts: DataFrame, key: str, count: str) -> DataFrame:
    """Most frequent first. The key breaks ties, and spreads them over the sort."""
    return counts.orderBy(F.desc(count), F.asc(key))


def access_log(lines: DataFrame, col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """The ten space-separated fields of each line, after the columns in ``keep``; missing ones are NULL."""
    return split_columns(lines.select(*keep, col), col, " ", ACCESS_FIELDS)


def log_counts(lines: DataFrame, by: str, name: str = "n", col: str = "value") -> DataFrame:
    """Lines per value of one access-log field, most frequent first."""
    counts = access_log(lines, col).groupBy(by).agg(F.count("*").alias(name))
    return _ranked(counts, by, name)


def endpoint_counts(lines: DataFrame, status: str = "200", col: str = "value") -> DataFrame:
    """Requests per endpoint in ``ip method endpoint status time`` lines of one status."""
    # Most lines of another status are told by a search for its text, before they are split.
    hits = grep(lines, col, status).where(token(col, 3) == status)
    counts = hits.groupBy(token(col, 2).alias("endpoint")).agg(F.count("*").alias("n"))
    return _ranked(counts, "endpoint", "n")


def error_words(lines: DataFrame, marker: str = "ERROR", col: str = "value") -> DataFrame:
    """Every word of the lines that contain the marker, in upper case."""
    return words(grep(lines.select(col), col, marker), col).select(F.upper("word").alias("word"))


def log_levels(lines: DataFrame, col: str = "value") -> DataFrame:
    """Level of each ``date time LEVEL message`` line."""
    return lines.select(token(col, 2).alias("level"))


def error_messages(lines: DataFrame, marker: str = "ERROR", col: str = "value") -> DataFrame:
    """Message of each ``date time LEVEL message`` line that contains the marker."""
    return grep(lines, col, marker).select(rest_of_line(col, 3).alias("message"))


def word_counts(texts: DataFrame, col: str) -> DataFrame:
    """How often each word occurs, most frequent first."""
    counts = words(texts.select(col), col).groupBy("word").agg(F.count("*").alias("n"))
    return _ranked(counts, "word", "n")
