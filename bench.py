"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR   tables to read   (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores      (default 8)

``python bench.py --all`` times every registered query, ``--oracle`` the SQL twins
in DuckDB on as many threads.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from workload import ORACLES, QUERIES  # noqa: E402

HEADLINE = [
    "item_similarity", "item_similarity_min", "similar_items", "item_avg_rating",
    "sessionize", "sessionize_hot", "win_running_sum", "win_rolling_range", "win_row_number",
    "join_three_way", "join_preaggregated", "join_salted", "join_self_pairs", "join_anti",
    "agg_sum_by", "agg_pivot", "agg_having_dups", "clean_dedupe", "set_subtract",
    "etl_orders", "etl_sales_by_group", "wh_spend", "wh_who_bought",
    "word_counts", "log_by_ip", "graph_degree", "topk", "sort_desc",
    "src_csv_roundtrip", "sink_partitioned",
]
RUNS = 3


def median_seconds(run) -> float:
    """Median of a few runs after one that is not counted."""
    run()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def spark_times(names: list[str], sf_dir: str, cpus: str) -> dict[str, float]:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times = {name: median_seconds(lambda name=name: run(name)) for name in names}
    spark.stop()
    return times


def oracle_times(names: list[str], sf_dir: str, cpus: str) -> dict[str, float]:
    import duckdb

    con = duckdb.connect(config={"threads": int(cpus)})
    for file in sorted(os.listdir(sf_dir)):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{sf_dir}/{file}'")
    return {n: median_seconds(lambda n=n: con.execute(ORACLES[n]).to_arrow_table()) for n in names}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sorted(QUERIES) if "--all" in sys.argv else HEADLINE
    measure = oracle_times if "--oracle" in sys.argv else spark_times
    times = measure(names, sf_dir, cpus)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
