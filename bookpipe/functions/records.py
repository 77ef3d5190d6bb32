"""JSON records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bookpipe.schema import nullable


def to_json_records(df: DataFrame, name: str = "value") -> DataFrame:
    """One JSON object per row; NULL fields are written, not left out."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(name))


def from_json_records(df: DataFrame, schema: T.StructType, name: str = "value") -> DataFrame:
    return df.select(F.from_json(name, nullable(schema)).alias("record")).select("record.*")


def book_url_of(record: Column) -> Column:
    return F.get_json_object(record, "$.book_url")
