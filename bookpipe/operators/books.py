"""Book pages to book records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookpipe.config import RunConfig
from bookpipe.functions import book_fields as B
from bookpipe.functions.urls import record_id
from bookpipe.operators.blocks import extract_blocks
from bookpipe.operators.validate import book_verdict, split_by_verdict
from bookpipe.profile import SHOP, SiteProfile


def book_values(blocks: Column, url: Column, profile: SiteProfile = SHOP) -> dict[str, Column]:
    """One Column per field of a book record."""
    bullets, products = blocks["bullets"], blocks["products"]
    values = {
        "title": blocks["title"],
        "isbn": B.isbn(bullets),
        "uuid": record_id(url),
        "author": B.authors(blocks["authors"]),
        "description": B.description(blocks["description"]),
        "date": B.date(bullets),
        "pages": B.pages(bullets),
        "price": B.price(blocks["formats"]),
        "best_seller_rank": B.best_seller_rank(products),
        "review_rating": B.review_rating(products),
        "review_count": B.review_count(products),
        "image_url": blocks["image"],
        "book_url": url,
    }
    values.update({name: make(blocks) for name, make in profile.overrides.items()})
    return values


def parse_books(
    pages: DataFrame, config: RunConfig = RunConfig(), profile: SiteProfile = SHOP, keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row per page: record fields, ``verdict`` (NULL if valid), no HTML.

    ``keep`` names further columns of ``pages`` to carry along.
    """
    blocks = pages.select("page_id", "url", *keep, extract_blocks("html", profile.book).alias("b"))
    b, url = F.col("b"), F.col("url")
    values = [value.alias(name) for name, value in book_values(b, url, profile).items()]
    verdict = book_verdict(b, config.banned_titles, config.language)
    return blocks.select("page_id", "url", *keep, *values, verdict.alias("verdict"))


def extract_books(
    pages: DataFrame, config: RunConfig = RunConfig(), profile: SiteProfile = SHOP
) -> tuple[DataFrame, DataFrame]:
    """(valid books, quarantine). Each side parses the pages when it runs."""
    return split_by_verdict(parse_books(pages, config, profile), config.on_error)
