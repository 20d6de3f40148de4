"""Catalog tables: create, replace, register, inspect, drop."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loomframe.operators.layout import hot_keys

#: Property of tables whose files were written for them.
OWNED = "loomframe.owned"


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def ensure_database(spark: SparkSession, db: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(db)}")


def create_table(
    spark: SparkSession, name: str, schema: StructType | str, fmt: str = "parquet"
) -> None:
    """An empty table with this schema, in place of any earlier one."""
    ddl = schema if isinstance(schema, str) else schema.toDDL()
    drop_table(spark, name)
    spark.sql(f"CREATE TABLE {_quoted(name)} ({ddl}) USING {fmt}")


def replace_table(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None) -> None:
    """Create the table or replace its whole content, also when ``df`` reads it.

    The rows go to files of their own first. A table of the same columns is then
    pointed to them, which is one step of the catalog: its name always leads to the
    old rows or to the new ones, and no byte is copied. Where columns differ the
    name is given anew. The retired files are removed last, unless they are files that
    were only registered. ``path`` holds the files and has to be new for each replacement.
    """
    spark = df.sparkSession
    base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    path = path or f"{base}/{name.rsplit('.', 1)[-1]}-{uuid.uuid4().hex}"
    df.write.format(fmt).save(path)
    if not spark.catalog.tableExists(name):
        register_external(spark, name, path, fmt)
        _own(spark, name)
        return
    owned = _property(spark, name, "Type") == "MANAGED" or OWNED in _property(spark, name, "Table Properties")
    retired = _property(spark, name, "Location") if owned else ""
    same = spark.table(name).dtypes == spark.read.format(fmt).load(path).dtypes
    if same and _property(spark, name, "Provider").lower() == fmt.lower():
        spark.sql(f"ALTER TABLE {_quoted(name)} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        drop_table(spark, name)
        register_external(spark, name, path, fmt)
    _own(spark, name)
    if retired:
        folder = spark._jvm.org.apache.hadoop.fs.Path(retired)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_bucketed(
    df: DataFrame, name: str, by: str | list[str], buckets: int, fmt: str = "parquet", most: float = 4.0
) -> None:
    """A catalog table whose rows lie in ``buckets`` files by the hash of ``by``, each sorted by it.

    Tables with equal buckets on their keys are joined and grouped on them without a shuffle.
    The price is that no task can share a bucket, so a key that by itself holds more
    than ``most`` buckets' share of the rows is refused: in a table without buckets
    adaptive execution splits such a key.
    """
    by = [by] if isinstance(by, str) else by
    share = most / buckets
    if share < 1:
        hot = hot_keys(df.select(*by), by, share, 1).limit(1).collect()
        if hot:
            raise ValueError(f"key {tuple(hot[0])} holds more than {share:.3f} of all rows; leave the table without buckets")
    # One task for each bucket, so that a bucket is one file.
    dealt = df.repartition(buckets, *by)
    dealt.write.format(fmt).bucketBy(buckets, *by).sortBy(*by).mode("overwrite").saveAsTable(name)


def _property(spark: SparkSession, name: str, key: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}").where(F.col("col_name") == key)
    found = rows.select("data_type").first()
    return found[0] if found else ""


def _own(spark: SparkSession, name: str) -> None:
    """Mark the files of a table as written for it, so that a replacement may remove them."""
    spark.sql(f"ALTER TABLE {_quoted(name)} SET TBLPROPERTIES ('{OWNED}' = 'true')")


def register_external(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    """A table over files that already exist; dropping it leaves them in place."""
    spark.catalog.createTable(name, path=path, source=fmt)


def list_tables(spark: SparkSession, db: str | None = None) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {_quoted(db)}" if db else "SHOW TABLES")


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {_quoted(name)}").select("col_name", "data_type")


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def preview(spark: SparkSession, name: str, n: int = 10) -> DataFrame:
    return spark.table(name).limit(n)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")


def drop_database(spark: SparkSession, db: str, cascade: bool = False) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {_quoted(db)} {'CASCADE' if cascade else 'RESTRICT'}")
