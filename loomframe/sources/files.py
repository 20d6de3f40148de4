"""Delimited and text files, and rows generated from a range."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

REJECT_COLUMN = "_rejected"


def _as_struct(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str,
    header: bool = True,
    sep: str = ",",
    encoding: str = "UTF-8",
) -> DataFrame:
    """Delimited files with a declared schema. ``path`` may hold wildcards.

    A field that does not parse as its type becomes NULL. The schema is always
    given, so the files are read once.
    """
    return spark.read.schema(schema).csv(path, sep=sep, header=header, encoding=encoding)


def read_dir(
    spark: SparkSession,
    directory: str,
    schema: StructType | str | None = None,
    header: bool = True,
    pattern: str = "*.csv",
) -> DataFrame:
    """Every matching CSV below a directory.

    Without a schema Spark infers one, which reads all the files a second time;
    declare it for anything large.
    """
    reader = spark.read.option("header", header).option("pathGlobFilter", pattern)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(directory)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text files as one string column, ``value``."""
    return spark.read.text(path)


def drop_header(lines: DataFrame, header: str, col: str = "value") -> DataFrame:
    """Remove every line equal to ``header``, in whichever file it stands."""
    return lines.where(~F.col(col).eqNullSafe(header))


def parse_delimited(
    lines: DataFrame, schema: StructType | str, sep: str = ",", col: str = "value"
) -> DataFrame:
    """Lines of delimited text as typed columns; unparsable fields are NULL."""
    ddl = schema if isinstance(schema, str) else schema.toDDL()
    record = F.from_csv(F.col(col), ddl, {"sep": sep})
    return lines.select(record.alias("record")).select("record.*")


def with_source_file(df: DataFrame, name: str = "filename") -> DataFrame:
    """Add the name of the file each row came from. ``df`` must be a file scan."""
    return df.withColumn(name, F.col("_metadata.file_name"))


def read_with_rejects(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str,
    header: bool = True,
    sep: str = ",",
) -> DataFrame:
    """CSV scan that keeps the raw text of malformed lines in ``_rejected``."""
    fields = [*_as_struct(schema).fields, StructField(REJECT_COLUMN, StringType())]
    return (
        spark.read.schema(StructType(fields))
        .option("columnNameOfCorruptRecord", REJECT_COLUMN)
        .csv(path, header=header, sep=sep, mode="PERMISSIVE")
    )


def split_malformed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Divide a ``read_with_rejects`` scan into (good rows, malformed rows).

    Spark parses only the fields that a query uses, and a line with one bad field
    would pass wherever that field is not selected. The hash, always true, makes
    every field count in both halves.
    """
    fields = [c for c in df.columns if c != REJECT_COLUMN]
    parsed = df.where(F.hash(*fields) <= F.lit(2**31 - 1))
    rejected = F.col(REJECT_COLUMN)
    return parsed.where(rejected.isNull()).drop(REJECT_COLUMN), parsed.where(rejected.isNotNull())


def sequence(spark: SparkSession, lo: int, hi: int) -> DataFrame:
    """Whole numbers from ``lo`` up to, not including, ``hi`` as column ``id``."""
    return spark.range(lo, hi)
