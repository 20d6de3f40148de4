from __future__ import annotations

import glob
import os

import pytest
from conftest import bag, values
from pyspark.sql import functions as F

from loomframe import sinks


def parts(path: str) -> list[str]:
    return glob.glob(os.path.join(path, "**", "part-*"), recursive=True)


def test_parquet_csv_and_text(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "id int, s string")
    sinks.write_parquet(df, str(tmp_path / "p"))
    assert bag(spark.read.parquet(str(tmp_path / "p"))) == bag(df)
    sinks.write_csv(df, str(tmp_path / "c"))
    assert bag(spark.read.csv(str(tmp_path / "c"), header=True, schema="id int, s string")) == bag(df)
    sinks.write_lines(df, str(tmp_path / "t"), "id")
    assert values(spark.read.text(str(tmp_path / "t"))) == ["1", "2"]


def test_single_file_only_below_the_limit(spark, tmp_path):
    df = spark.range(100).repartition(7)
    sinks.write_files(df, str(tmp_path / "one"), 1)
    assert len(parts(str(tmp_path / "one"))) == 1
    sinks.write_files(df, str(tmp_path / "few"), 4)
    assert len(parts(str(tmp_path / "few"))) == 4
    assert spark.read.csv(str(tmp_path / "few"), header=True).count() == 100


def test_partitioned_output_has_a_directory_per_value(spark, tmp_path):
    df = spark.range(1000).select("id", F.when(F.col("id") < 900, "big").otherwise("small").alias("city"))
    sinks.write_partitioned(df, str(tmp_path / "out"), "city")
    assert sorted(d for d in os.listdir(tmp_path / "out") if "=" in d) == ["city=big", "city=small"]
    back = spark.read.parquet(str(tmp_path / "out")).where("city = 'small'")
    assert back.count() == 100
    assert "PartitionFilters: [isnotnull(city" in back._jdf.queryExecution().toString()


def test_table_life_cycle(spark):
    sinks.ensure_database(spark, "lake")
    sinks.ensure_database(spark, "lake")
    sinks.create_table(spark, "lake.passengers", "passenger_id int, survived boolean, fare double")
    assert sinks.count_rows(spark.table("lake.passengers")).first()[0] == 0
    assert bag(sinks.describe(spark, "lake.passengers")) == {
        ("passenger_id", "int"): 1, ("survived", "boolean"): 1, ("fare", "double"): 1,
    }
    sinks.replace_table(spark.range(3).toDF("n"), "lake.numbers")
    sinks.replace_table(spark.range(5).toDF("n"), "lake.numbers")
    assert values(sinks.preview(spark, "lake.numbers")) == [0, 1, 2, 3, 4]
    assert values(sinks.list_tables(spark, "lake").select("tableName")) == ["numbers", "passengers"]
    sinks.drop_table(spark, "lake.numbers")
    sinks.drop_table(spark, "lake.numbers")
    assert not spark.catalog.tableExists("lake.numbers")
    with pytest.raises(Exception, match="(?i)empty"):
        sinks.drop_database(spark, "lake")
    sinks.drop_database(spark, "lake", cascade=True)
    assert not spark.catalog.databaseExists("lake")


def test_a_table_can_be_replaced_from_itself(spark):
    sinks.replace_table(spark.range(3).toDF("n"), "counter")
    more = spark.table("counter").withColumn("n", F.col("n") + 10)
    sinks.replace_table(more, "counter")
    assert values(spark.table("counter")) == [10, 11, 12]
    sinks.drop_table(spark, "counter")


def test_a_failed_replacement_leaves_the_old_table(spark):
    sinks.replace_table(spark.range(3).toDF("n"), "kept")
    with pytest.raises(Exception):
        sinks.replace_table(spark.range(3).select(F.raise_error(F.lit("no")).alias("n")), "kept")
    assert values(spark.table("kept")) == [0, 1, 2]
    sinks.drop_table(spark, "kept")


def test_external_table_leaves_its_files(spark, tmp_path):
    path = str(tmp_path / "it's here")
    sinks.write_parquet(spark.range(4).toDF("n"), path)
    sinks.register_external(spark, "outside", path)
    assert spark.table("outside").count() == 4
    sinks.drop_table(spark, "outside")
    assert spark.read.parquet(path).count() == 4


def test_scratch_is_in_the_shared_folder(spark):
    a, b = sinks.scratch_dir(spark, "x"), sinks.scratch_dir(spark, "x")
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_failed_replacement_leaves_the_old_rows(spark, monkeypatch):
    from loomframe.sinks import tables

    name = "kept_rows"
    sinks.replace_table(spark.range(3), name)
    before = tables._property(spark, name, "Location")

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(tables, "_property", fail)
    with pytest.raises(RuntimeError, match="lost"):
        sinks.replace_table(spark.range(9), name)
    monkeypatch.undo()
    assert spark.table(name).count() == 3
    sinks.replace_table(spark.table(name).union(spark.range(5)), name)
    assert spark.table(name).count() == 8
    assert tables._property(spark, name, "Location") != before
    assert not os.path.exists(before.removeprefix("file:"))
    sinks.replace_table(spark.range(2).selectExpr("id", "'x' AS other"), name)
    assert spark.table(name).columns == ["id", "other"]
    sinks.drop_table(spark, name)


def test_registered_files_outlive_a_replacement(spark, tmp_path):
    spark.range(4).write.parquet(f"{tmp_path}/given")
    sinks.register_external(spark, "given_rows", f"{tmp_path}/given")
    sinks.replace_table(spark.range(1), "given_rows", path=f"{tmp_path}/new")
    assert spark.table("given_rows").count() == 1
    assert spark.read.parquet(f"{tmp_path}/given").count() == 4
    sinks.drop_table(spark, "given_rows")


def test_bucketed_tables_join_without_a_shuffle(spark):
    left = spark.range(1000).select("id", (F.col("id") * 2).alias("v"))
    right = spark.range(500).select((F.col("id") % 200).alias("id"), F.lit(1).alias("w"))
    sinks.write_bucketed(left, "left_side", "id", 4)
    sinks.write_bucketed(right, "right_side", "id", 4)
    joined = spark.table("left_side").join(spark.table("right_side").hint("merge"), "id").groupBy("id").agg(F.sum("w").alias("n"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert bag(joined) == bag(left.join(right, "id").groupBy("id").agg(F.sum("w").alias("n")))
    sinks.write_bucketed(left.limit(10), "left_side", "id", 4)
    assert spark.table("left_side").count() == 10


def test_a_key_too_large_for_a_bucket_is_refused(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, 7).otherwise(F.col("id")).alias("k"))
    with pytest.raises(ValueError, match="holds more than"):
        sinks.write_bucketed(df, "hot_side", "k", 16)
    assert not spark.catalog.tableExists("hot_side")
    sinks.write_bucketed(df, "hot_side", "k", 4)
    assert spark.table("hot_side").count() == 1000


def test_only_the_given_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "days")
    days = spark.createDataFrame([(d, f"{d}-{i}") for d in (1, 2, 3) for i in range(4)], "day int, v string")
    sinks.replace_partitions(days, path, "day")
    untouched = {f for f in parts(path) if "day=2" not in f}
    again = spark.createDataFrame([(2, "new"), (2, "newer")], "day int, v string")
    for _ in range(2):
        sinks.replace_partitions(again, path, "day")
    assert {f for f in parts(path) if "day=2" not in f} == untouched
    assert bag(spark.read.parquet(path), "day", "v") == bag(days.where("day <> 2").union(again))
    sinks.replace_partitions(again.limit(0), path, "day")
    assert spark.read.parquet(path).count() == 10
