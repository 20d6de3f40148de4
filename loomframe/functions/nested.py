"""JSON text and nested structs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def parse_json(df: DataFrame, col: str, schema: StructType | str, name: str = "parsed") -> DataFrame:
    """Add the struct held in a JSON text column; text that is no JSON gives NULLs."""
    return df.withColumn(name, F.from_json(F.col(col), schema))


def flatten_struct(df: DataFrame, col: str) -> DataFrame:
    """Replace a struct column by its fields."""
    return df.select(*[F.col(c) for c in df.columns if c != col], f"{col}.*")
