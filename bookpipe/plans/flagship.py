"""What must the next run store? Frontier, quota and merge over two tables.

Books are ``part`` rows, reviews are ``lineitem`` rows; lines shipped before the
cut-off are saved already, the rest are new.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookpipe.operators.counts import work_target
from bookpipe.operators.joins import narrow
from bookpipe.operators.listing import most_reviewed
from bookpipe.operators.reviews import fill_reviews
from bookpipe.operators.validate import banned
from bookpipe.plans.derived_pages import shipped_before_cutoff
from bookpipe.session import checkpointed

ARRIVAL = ("l_orderkey", "l_linenumber", "user", "rating")


def line_reviews(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_partkey").alias("isbn"),
        F.col("l_suppkey").alias("user"),
        F.col("l_quantity").alias("rating"),
        "l_orderkey",
        "l_linenumber",
        shipped_before_cutoff().alias("is_saved"),
    )


def next_increment(part: DataFrame, lineitem: DataFrame, num_books: int, num_reviews: int) -> DataFrame:
    """``(isbn, rk, usr, rating, pos)`` of the reviews the next run adds.

    One aggregate gives both the saved count and the popularity of each book; it
    is one row per book and is kept, since target, frontier and quota all read it.
    """
    reviews = line_reviews(lineitem)
    books = checkpointed(
        reviews.groupBy("isbn").agg(F.count("*").alias("review_count"), F.count_if("is_saved").alias("n"))
    )
    k = work_target(books.where(F.col("n") >= num_reviews).count(), num_books)
    picks = most_reviewed(books.where(F.col("n") < num_reviews), k)
    catalogue = part.select(F.col("p_partkey").alias("isbn"), "p_name", "p_type")
    valid = (
        catalogue.where(~banned(F.col("p_name"), ["gizmo"]) & (F.col("p_type") != "PROMO"))
        .join(picks.select("isbn", F.col("rank").alias("rk")), "isbn")
        .select("isbn", "rk")
    )
    fresh = narrow(reviews.where(~F.col("is_saved")).drop("is_saved"), valid, "isbn", bound=k)
    saved = narrow(reviews.where("is_saved").select("isbn", "user"), valid, "isbn", bound=k)
    filled = fill_reviews(fresh, saved, num_reviews, ARRIVAL, counts=books.select("isbn", "n"))
    return filled.join(valid, "isbn").select(
        "isbn", "rk", F.col("user").alias("usr"), "rating", F.col("position").alias("pos")
    )


def flagship(part: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Three quarters of all books with 12 reviews each."""
    return next_increment(part, lineitem, math.floor(0.75 * part.count()), 12)
