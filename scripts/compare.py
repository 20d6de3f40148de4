"""Run registered queries on Spark and their SQL twins on DuckDB and compare the rows.

    python scripts/compare.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time
import traceback
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from workload import ORACLES, QUERIES  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def arrow_rows(table, names: list[str]) -> Counter:
    return Counter(zip(*[table.column(n).to_pylist() for n in names])) if names else Counter()


def _kind(arrow_type) -> str:
    name = str(arrow_type)
    return {"large_string": "string", "timestamp[us]": "timestamp", "timestamp[ns]": "timestamp"}.get(
        name, name
    )


def mismatch(actual, expected) -> str | None:
    """What differs between two arrow tables, ignoring the order of rows and columns."""
    names = sorted(actual.column_names)
    if names != sorted(expected.column_names):
        return f"columns {names} against {sorted(expected.column_names)}"
    kinds = [
        (n, _kind(actual.schema.field(n).type), _kind(expected.schema.field(n).type)) for n in names
    ]
    wrong = [k for k in kinds if k[1] != k[2]]
    if wrong:
        return f"types {wrong}"
    if actual.num_rows != expected.num_rows:
        return f"rows {actual.num_rows} against {expected.num_rows}"
    got, want = arrow_rows(actual, names), arrow_rows(expected, names)
    if got != want:
        return f"values {names}: only here {list((got - want).items())[:3]}, only there {list((want - got).items())[:3]}"
    return None


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = duck(sf_dir), 0
    for name in args.names or sorted(QUERIES):
        start = time.time()
        try:
            actual = QUERIES[name](spark, sf_dir).toArrow()
            if name not in ORACLES:
                print(f"rows  {name}: {actual.num_rows}", flush=True)
                continue
            expected = con.execute(ORACLES[name]).to_arrow_table()
            problem = mismatch(actual, expected)
        except Exception as error:
            problem = "".join(traceback.format_exception_only(error)).strip()[:1500]
        failed += problem is not None
        print(
            f"{'FAIL' if problem else 'ok  '} {name}: {problem or actual.num_rows} "
            f"({time.time() - start:.1f} s)",
            flush=True,
        )
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
