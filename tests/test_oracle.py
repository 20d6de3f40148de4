"""Every registered query against its SQL twin in DuckDB, and none through Python."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__  # noqa: E402
from compare import duck, mismatch  # noqa: E402
from workload import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(__spark_entry__.queries())


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["item1", "item2", "score", "num_pairs"]
    assert df.count() == 45


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    expected = con.sql(ORACLES[name]).to_arrow_table()
    assert mismatch(df.toArrow(), expected) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(python in plan for python in ("BatchEvalPython", "ArrowEvalPython", "InPandas"))
