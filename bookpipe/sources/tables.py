"""Relational reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bookpipe.operators.joins import members
from bookpipe.schema import nullable


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """S5."""
    return spark.table(name)


def table_or_empty(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """A missing table reads as an empty one."""
    if spark.catalog.tableExists(name):
        return read_table(spark, name).select(*schema.names)
    return spark.createDataFrame([], nullable(schema))


def saved_isbns(attributes: DataFrame) -> DataFrame:
    """S7."""
    return attributes.select("isbn")


def saved_users(reviews: DataFrame, isbns: DataFrame | str) -> DataFrame:
    """``(isbn, user)`` of one book, or of all given books in one join."""
    rows = reviews.select("isbn", "user")
    if isinstance(isbns, str):
        return rows.where(F.col("isbn") == F.lit(isbns))
    return members(rows, isbns, "isbn")
