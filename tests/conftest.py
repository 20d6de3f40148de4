from __future__ import annotations

import os
import sys
from collections import Counter

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("loomframe-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def bag(df: DataFrame, *cols: str) -> Counter:
    """The rows as a multiset of tuples."""
    return Counter(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def values(df: DataFrame) -> list:
    """A one-column frame as a sorted list."""
    return sorted(r[0] for r in df.collect())


def final_plan(df: DataFrame) -> str:
    """The physical plan after adaptive execution, without the initial one."""
    df._jdf.queryExecution().executedPlan()
    df.toArrow()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
