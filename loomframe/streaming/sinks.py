"""Streams from and to folders of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def follow_files(
    spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", files: int | None = None, **options: str
) -> DataFrame:
    """The files of a folder as a stream, ``files`` of them in a batch."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    return (reader if files is None else reader.option("maxFilesPerTrigger", files)).load(path)


def drained(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Take in all that has come by now, append results to ``path``, and stop.

    The next call with the same ``checkpoint`` goes on where this one ended, also after
    one that was broken off: the sink notes which files belong to which batch, so a
    repeated batch replaces what it had begun and no row comes out twice. Read ``path`` as a
    whole, with ``spark.read``, which follows those notes.
    """
    query = (
        stream.writeStream.format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    finally:
        query.stop()
