"""Review pages to the reviews still missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bookpipe.functions.review_fields import star_rating
from bookpipe.operators.blocks import extract_blocks
from bookpipe.operators.counts import reviews_per_book
from bookpipe.operators.joins import dealt, with_saved_count, without
from bookpipe.operators.listing import has_next_review_page
from bookpipe.operators.ranking import top_per_group
from bookpipe.profile import SHOP, SiteProfile


def read_review_pages(
    pages: DataFrame, profile: SiteProfile = SHOP, keep: Sequence[str] = ("isbn", "page_no")
) -> DataFrame:
    """``(*keep, reviews, more)``, one row a page; ``more`` is what its pager says, true without one."""
    blocks = pages.select(*keep, extract_blocks("html", profile.reviews).alias("b"))
    more = has_next_review_page(F.col("b.pager")) if "pager" in profile.reviews else F.lit(True)
    return blocks.select(*keep, F.col("b.reviews").alias("reviews"), more.alias("more"))


def reviews_of(pages: DataFrame, keep: Sequence[str] = ("isbn", "page_no")) -> DataFrame:
    """``(*keep, pos, user, text, rating)`` of the complete reviews of pages that are read."""
    rows = pages.select(*keep, F.posexplode("reviews").alias("pos", "r"))
    return complete_reviews(rows.select(*keep, "pos", "r.user", "r.text", star_rating(F.col("r.stars")).alias("rating")))


def up_to_last(pages: DataFrame, book: str = "book_url") -> DataFrame:
    """Pages of each book up to the first whose pager has no next page."""
    last = pages.where(~F.col("more")).groupBy(book).agg(F.min("page_no").alias("_last"))
    near = pages.join(dealt(last), book, "left")
    return near.where(F.col("_last").isNull() | (F.col("page_no") <= F.col("_last"))).drop("_last")


def extract_reviews(pages: DataFrame, profile: SiteProfile = SHOP, keep: Sequence[str] = ("isbn", "page_no")) -> DataFrame:
    """``(*keep, pos, user, text, rating)`` of complete reviews, in page order."""
    return reviews_of(read_review_pages(pages, profile, keep), keep)


def complete_reviews(reviews: DataFrame) -> DataFrame:
    """V6: a review needs a user and a text."""
    return reviews.dropna(subset=["user", "text"])


def fill_reviews(
    candidates: DataFrame,
    saved: DataFrame,
    num_reviews: int,
    order: Sequence[str] = ("page_no", "pos"),
    counts: DataFrame | None = None,
    dedup_first: bool = False,
    visit: str | None = None,
) -> DataFrame:
    """P5: each book's first new reviews until it has ``num_reviews``.

    Adds ``position``, the place among the book's new reviews. No user can fill
    more places than the quota, so candidates are cut per (isbn, user) first.
    That shuffle also serves the anti join and spreads a hot book over its users;
    after it, a book is cut to ``num_reviews`` rows per split before it is ranked.

    ``visit`` names the leading order column that tells visits of one book under
    several URLs apart: a user met at one visit is skipped at later ones.
    """
    per_user = min(num_reviews, 1) if dedup_first else num_reviews
    capped = top_per_group(candidates, ["isbn", "user"], order, per_user, "_nth", spread_by=order)
    if visit is not None:
        first_visit = F.min(visit).over(Window.partitionBy("isbn", "user"))
        capped = capped.withColumn("_visit", first_visit).where(F.col(visit) == F.col("_visit")).drop("_visit")
    fresh = without(capped.drop("_nth"), saved, ["isbn", "user"])
    ranked = top_per_group(fresh, ["isbn"], order, num_reviews, "position", spread_by=["user", *order])
    counted = with_saved_count(ranked, reviews_per_book(saved) if counts is None else counts)
    return counted.where(F.col("position") <= num_reviews - F.col("saved")).drop("saved")


def nest_reviews(reviews: DataFrame, position: str = "position") -> DataFrame:
    """A5: ``(isbn, reviews)`` in order.

    For the output of :func:`fill_reviews`, where a book has at most
    ``num_reviews`` rows; not for a whole store.
    """
    fields = [c for c in reviews.columns if c not in ("isbn", position)]
    ordered = F.sort_array(F.collect_list(F.struct(position, F.struct(*fields).alias("review"))))
    return reviews.groupBy("isbn").agg(F.transform(ordered, lambda r: r["review"]).alias("reviews"))
