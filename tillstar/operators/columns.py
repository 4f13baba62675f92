"""Columns of a frame by kind."""

from pyspark.sql import DataFrame
from pyspark.sql.types import NumericType, StringType


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def has(df: DataFrame, *names: str) -> bool:
    return set(names) <= set(df.columns)
