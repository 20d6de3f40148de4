"""File outputs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path for intermediate files, in the folder all executors share.

    That folder is the session's checkpoint directory. Only a local session may
    go without one; it then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="loomframe-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.parquet(path, mode=mode)


def write_csv(
    df: DataFrame, path: str, header: bool = True, sep: str = ",", mode: str = "errorifexists"
) -> None:
    df.write.csv(path, mode=mode, header=header, sep=sep)


def write_lines(df: DataFrame, path: str, col: str = "value", mode: str = "errorifexists") -> None:
    df.select(F.col(col).cast("string").alias("value")).write.mode(mode).text(path)


def write_files(df: DataFrame, path: str, files: int) -> None:
    """CSV in ``files`` files with a header, whatever the number of rows.

    Every file is written by one task, so one file is a choice for small results
    and the caller's to make.
    """
    df.repartition(files).write.csv(path, header=True)


def write_partitioned(
    df: DataFrame, path: str, by: str | list[str], fmt: str = "parquet", mode: str = "errorifexists"
) -> None:
    """One directory per value of ``by``.

    Rows are brought together by value so that each directory gets few files. The
    rebalance hint lets adaptive execution split a value that holds a large part
    of the data over several tasks, where a plain repartition would not.
    """
    by = [by] if isinstance(by, str) else by
    df.hint("rebalance", *by).write.partitionBy(*by).format(fmt).mode(mode).save(path)


def replace_partitions(df: DataFrame, path: str, by: str | list[str], fmt: str = "parquet") -> None:
    """Replace the directories of those values of ``by`` that ``df`` holds, and no others.

    A repeated run of one day thus gives the same table as one run. A value without
    rows in ``df`` keeps its directory; to empty it, delete it.
    """
    by = [by] if isinstance(by, str) else by
    writer = df.hint("rebalance", *by).write.partitionBy(*by).format(fmt).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").save(path)
