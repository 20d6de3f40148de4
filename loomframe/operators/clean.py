"""Data-quality rules: a bad value becomes NULL, a row with a NULL is dropped."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

# Patterns of the data model. Fixed values.
EMAIL = r"([a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+)"
PHONE = r"^(\+?\d{1,3}[\s.-]?)?(\(\d{3}\)|\d{3})[\s.-]?\d{3}[\s.-]?\d{4}$"
ORDER_ID = r"^\d{6}$"
CUSTOMER_ID = r"^\d{4}$"
PRODUCT_ID = r"^\w\d{4}$"
PUNCTUATION = r"[^a-zA-Z0-9\s]"


class Account:
    """Counts what a cleaning job sees and drops, in the pass that does the work.

    Rules take it as ``account`` and attach observed metrics to their step, so the input is
    not read again. ``report`` waits for the first action on the cleaned rows and gives
    its counts. A job with an account serves one action. Where Spark has to repeat a step
    after it lost an executor, the counts of that step may hold the repeated tasks twice.
    """

    def __init__(self) -> None:
        self._seen: list[Observation] = []

    def watch(self, df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
        """``df``, with aggregates to be noted as its rows pass."""
        seen = Observation()
        self._seen.append(seen)
        return df.observe(seen, *[c.alias(n) for n, c in metrics.items()])

    def counts(self) -> dict[str, int]:
        """What was seen, in the order of the steps."""
        return {name: n for seen in self._seen for name, n in seen.get.items()}

    def report(self, spark: SparkSession) -> DataFrame:
        """The counts as rows: ``metric`` and ``n``."""
        return spark.createDataFrame(list(self.counts().items()), "metric string, n long")


def dedupe(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Drop repeated rows, or keep the smallest row per key.

    Both forms aggregate before they shuffle, so a row with very many copies
    leaves each task once.
    """
    if not keys:
        return df.dropDuplicates()
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).dropDuplicates()
    kept = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("kept"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"kept.{c}") for c in df.columns])


def drop_nulls(df: DataFrame, cols: list[str] | None = None, account: Account | None = None) -> DataFrame:
    """Drop rows with a NULL (or NaN) in any of the columns; ``account`` counts the NULLs per column and the rows that go."""
    checked = df.columns if cols is None else cols
    if account is not None:
        some = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in checked])
        nulls = {f"{c}_null": F.count_if(F.col(c).isNull()) for c in checked}
        df = account.watch(df, nulls | {"rows_with_null": F.count_if(some)})
    kinds = {f.name: f.dataType for f in df.schema}
    for col in checked:
        there = F.col(col).isNotNull()
        # One condition for each column: the optimizer moves each of them as far down as its own column allows.
        df = df.where(there & ~F.isnan(col) if isinstance(kinds.get(col), (DoubleType, FloatType)) else there)
    return df


def fill_mean(df: DataFrame, col: str) -> DataFrame:
    """Fill NULLs with the mean of the column, which becomes a double."""
    mean = df.agg(F.avg(col)).scalar()
    return df.withColumn(col, F.coalesce(F.col(col).cast("double"), mean))


def fill_const(df: DataFrame, values: dict[str, Any]) -> DataFrame:
    """Fill NULLs per column with a constant of the column's type."""
    return df.fillna(values)


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip spaces at both ends of every string column."""
    return df.withColumns({f.name: F.trim(f.name) for f in df.schema if isinstance(f.dataType, StringType)})


def validate(
    df: DataFrame, rules: dict[str, str], anchored: bool = False, account: Account | None = None
) -> DataFrame:
    """Keep values in which the column's pattern is found, NULL the others.

    ``anchored`` asks for the pattern to cover the whole value. ``account`` counts the values set to NULL per column.
    """
    form = "^(?:{})$" if anchored else "{}"
    fits = {c: F.col(c).rlike(form.format(p)) for c, p in rules.items()}
    if account is not None:
        df = account.watch(df, {f"{c}_invalid": F.count_if(~fit) for c, fit in fits.items()})
    return df.withColumns({c: F.when(fit, F.col(c)) for c, fit in fits.items()})


def strip_chars(df: DataFrame, col: str, pattern: str = PUNCTUATION) -> DataFrame:
    """Remove everything the pattern matches, by default punctuation."""
    return df.withColumn(col, F.regexp_replace(col, pattern, ""))


def upper(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.upper(col))


def clamp_min(df: DataFrame, col: str, floor: float = 0) -> DataFrame:
    """Raise smaller values to ``floor``; NULL stays NULL."""
    kind = dict(df.dtypes)[col]
    low = F.lit(floor).cast(kind)
    return df.withColumn(col, F.when(F.col(col) < low, low).otherwise(F.col(col)))


def fix_sign(df: DataFrame, cols: list[str]) -> DataFrame:
    """Make negative amounts positive."""
    return df.withColumns({c: F.abs(c) for c in cols})
