"""Counts over the saved state."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookpipe.operators.joins import dealt, without


def reviews_per_book(reviews: DataFrame, mode: str = "rows", isbns: DataFrame | None = None) -> DataFrame:
    """A1: ``(isbn, n)``.

    ``rows`` counts stored rows, and a book without reviews has no row. ``users``
    counts distinct reviewers, and with ``isbns`` given keeps their zeros.
    """
    counted = F.count("*") if mode == "rows" else F.count_distinct("user")
    counts = reviews.where(F.col("isbn").isNotNull()).groupBy("isbn").agg(counted.alias("n"))
    if mode == "rows" or isbns is None:
        return counts
    return (
        distinct_isbns(isbns)
        .join(counts, "isbn", "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
    )


def distinct_isbns(df: DataFrame) -> DataFrame:
    """A2, U3."""
    return df.select("isbn").distinct()


def satisfied_books(counts: DataFrame, num_reviews: int) -> DataFrame:
    """A3: books that have enough reviews."""
    return counts.where(F.col("n") >= num_reviews)


def satisfied_urls(counts: DataFrame, attributes: DataFrame, num_reviews: int) -> DataFrame:
    """``(isbn, book_url, n)`` of satisfied books; duplicate attribute rows multiply."""
    enough = satisfied_books(counts, num_reviews).select("isbn", "n")
    return dealt(attributes.select("isbn", "book_url")).join(enough, "isbn")


def orphans(counts: DataFrame, attributes: DataFrame, num_reviews: int) -> DataFrame:
    """Satisfied isbns that have no attributes, as quarantine rows."""
    return without(satisfied_books(counts, num_reviews), attributes, "isbn").select(
        F.lit(None).cast("bigint").alias("page_id"),
        F.lit(None).cast("string").alias("url"),
        F.lit("isbn").alias("field"),
        F.concat(F.lit("reviews without attributes: "), F.col("isbn").cast("string")).alias("reason"),
    )


def by_popularity(counts: DataFrame) -> DataFrame:
    """Most reviewed first, ties by isbn."""
    return counts.orderBy(F.desc("n"), "isbn")


def work_target(satisfied: int, num_books: int, surplus: float = 0.05) -> int:
    """Books still to process, with a floored surplus against failures."""
    missing = max(num_books - satisfied, 0)
    return missing + math.floor(missing * surplus)


def work_target_row(satisfied: DataFrame, num_books: DataFrame, surplus: float = 0.05) -> DataFrame:
    """P1 and A4 as a one-row table; ``num_books`` is a one-row table too."""
    done = satisfied.agg(F.count("*").alias("satisfied")).scalar()
    missing = F.greatest(F.col("num_books") - F.col("satisfied"), F.lit(0))
    return (
        num_books.select("num_books")
        .withColumn("satisfied", done)
        .withColumn("missing", missing)
        .withColumn("target", F.col("missing") + F.floor(F.col("missing") * surplus).cast("bigint"))
    )
