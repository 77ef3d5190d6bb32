"""Captured pages."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bookpipe.functions.urls import normalize_url
from bookpipe.operators.joins import dealt_to_pages
from bookpipe.schema import CAPTURE, PAGE, conform, nullable
from bookpipe.sources.raw_tree import list_names


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, url, html)``."""
    return conform(spark.read.parquet(path), PAGE)


#: Parts that pages of one kind are laid out in, by the book they belong to.
BUCKETS = 64


def bucket_of(book: Column) -> Column:
    return F.pmod(F.xxhash64(book), F.lit(BUCKETS)).cast("int")


def laid_out(captures: DataFrame) -> DataFrame:
    """Captures with ``bucket``, and book URLs as runs compare them.

    Book and review pages go by their book, listing pages by their number.
    """
    rows = conform(captures, CAPTURE)
    book = F.when(F.col("kind") == "book", normalize_url(F.col("url"))).otherwise(normalize_url(F.col("book_url")))
    rows = rows.withColumn("book_url", book)
    return rows.withColumn("bucket", bucket_of(F.coalesce("book_url", F.col("page_no").cast("string"))))


def write_captures(captures: DataFrame, path: str) -> None:
    """Captures as a table that runs read in part: by kind, and the buckets of the books they work."""
    laid_out(captures).write.partitionBy("kind", "bucket").mode("append").parquet(path)


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """Landed captures, as plain files or as :func:`write_captures` lays them out."""
    fields = [*CAPTURE.fields]
    if any(name.startswith("kind=") for name in list_names(spark, path)):
        fields.append(T.StructField("bucket", T.IntegerType()))
    return spark.read.schema(nullable(T.StructType(fields))).parquet(path)


def in_buckets(pages: DataFrame, books: DataFrame, on: str) -> tuple[DataFrame, list[str]]:
    """Books with the bucket of their pages, and the columns to join them on.

    The bucket is a partition of laid-out captures: the join prunes all others as it runs
    (the comparison tells the optimizer that the books are a selection).
    """
    if "bucket" not in pages.columns:
        return books, [on]
    return books.withColumn("bucket", bucket_of(F.col(on))).where(F.col("bucket") >= 0), [on, "bucket"]


class Captures(NamedTuple):
    """The three kinds of page one run reads."""

    listing: DataFrame
    books: DataFrame
    reviews: DataFrame

    @classmethod
    def of(cls, captures: DataFrame) -> Captures:
        """The kinds of a table of captures; one that is laid out in buckets keeps them."""
        laid = "bucket" in captures.columns
        rows = captures.to(nullable(T.StructType([*CAPTURE.fields, T.StructField("bucket", T.IntegerType())]))) if laid else conform(captures, CAPTURE)
        return cls(*(rows.where(F.col("kind") == kind).drop("kind") for kind in ("listing", "book", "review")))


def latest(pages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest capture of each page.

    The newest id per key is an aggregate over narrow columns, combined before
    its shuffle; bodies are only joined to it. A capture that has landed twice
    comes twice: repeats are taken out after parsing, on narrow rows.
    """
    newest = pages.groupBy(*keys).agg(F.max("page_id").alias("page_id"))
    return pages.join(dealt_to_pages(newest), [*keys, "page_id"], "left_semi")
