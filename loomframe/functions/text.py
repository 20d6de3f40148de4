"""Splitting lines into fields and words."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A run of characters that are no Unicode white space and no separator control; possessive, as a run never has to be
# given back. Fixed value.
WORD = r"(?U)[^\s\x1c-\x1f]++"
# The first character of a word. Fixed value.
IN_WORD = r"(?U)[^\s\x1c-\x1f]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_literal(c: Column | str, sep: str) -> Column:
    """Fields between separators, empty ones included."""
    return F.split(_col(c), re.escape(sep))


def tokens(c: Column | str) -> Column:
    """Words of a text: runs of white space separate, and none is left at the ends."""
    return F.regexp_extract_all(_col(c), F.lit(WORD), F.lit(0))


def has_words(c: Column | str) -> Column:
    """Whether a text has a word; as a filter, this looks at a text's first word only, and ``tokens`` would be computed twice."""
    return _col(c).rlike(IN_WORD)


def field(c: Column | str, position: int, sep: str = " ") -> Column:
    """The field at a 0-based position, NULL where the line is too short."""
    return F.get(split_literal(c, sep), position)


def token(c: Column | str, position: int) -> Column:
    """The word at a 0-based position, NULL where there are fewer."""
    return F.get(tokens(c), position)


def rest_of_line(c: Column | str, start: int) -> Column:
    """The words from a 0-based position to the end, joined by single spaces."""
    parts = tokens(c)
    return F.array_join(F.slice(parts, start + 1, F.greatest(F.size(parts), F.lit(1))), " ")


def split_columns(df: DataFrame, col: str, sep: str, names: list[str]) -> DataFrame:
    """Replace a text column by one column per field; missing fields are NULL."""
    return df.withColumns({n: field(col, i, sep) for i, n in enumerate(names)}).drop(col)


def grep(df: DataFrame, col: str, text: str) -> DataFrame:
    """Rows whose column contains ``text``."""
    return df.where(F.col(col).contains(text))


def words(df: DataFrame, col: str, name: str = "word") -> DataFrame:
    """One row per word, with the other columns repeated."""
    return df.select(*[c for c in df.columns if c != col], F.explode(tokens(col)).alias(name))


def word_lengths(df: DataFrame, col: str) -> DataFrame:
    """One (word, length) row per word."""
    return words(df.select(col), col).select("word", F.length("word").alias("length"))
