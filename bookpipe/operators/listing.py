"""Listing pages and the frontier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookpipe.functions.urls import absolute_url, normalize_url
from bookpipe.operators.blocks import extract_blocks
from bookpipe.operators.joins import without
from bookpipe.operators.ranking import SMALL_PREFIX, first_k, one_per_key, total_before
from bookpipe.profile import SHOP, SiteProfile
from bookpipe.session import checkpointed


def listing_blocks(pages: DataFrame, profile: SiteProfile = SHOP) -> DataFrame:
    """``(page_no, url, links, has_next)`` of each listing page."""
    blocks = pages.select("page_no", "url", extract_blocks("html", profile.listing).alias("b"))
    return blocks.select("page_no", "url", F.col("b.links").alias("links"), has_next(F.col("b.strip")).alias("has_next"))


def read_listing_pages(pages: DataFrame, profile: SiteProfile = SHOP, keep: Sequence[str] = ("page_no",)) -> DataFrame:
    """``(*keep, page_url, links)``, one row a page."""
    return pages.select(*keep, F.col("url").alias("page_url"), extract_blocks("html", profile.listing)["links"].alias("links"))


def links_of(listed: DataFrame, keep: Sequence[str] = ("page_no",)) -> DataFrame:
    """``(*keep, pos, url)`` of listing pages that are read."""
    links = listed.select(*keep, "page_url", F.posexplode("links").alias("pos", "href"))
    return links.where("href is not null").select(
        *keep, "pos", normalize_url(absolute_url(F.col("href"), F.col("page_url"))).alias("url")
    )


def listing_links(pages: DataFrame, profile: SiteProfile = SHOP) -> DataFrame:
    """``(page_no, pos, url)``, normalized, in page order."""
    return links_of(read_listing_pages(pages, profile))


def has_next(strip: Column) -> Column:
    """The last child of the pagination strip is not disabled."""
    return (F.size(strip) > 0) & F.try_element_at(strip, F.lit(-1)).isNull()


def has_next_review_page(pager: Column) -> Column:
    """The second pager item is exactly the enabled ``next`` item."""
    return F.coalesce(F.try_element_at(pager, F.lit(2)) == "a-last", F.lit(False))


def frontier(
    links: DataFrame,
    satisfied: DataFrame,
    k: int,
    order: Sequence[str | Column] = ("page_no", "pos"),
    small: int = SMALL_PREFIX,
) -> DataFrame:
    """The first ``k`` listed URLs that are not satisfied, with their rank.

    Repeats of a URL are kept and count towards ``k``. ``order`` may name any
    criterion; it must end in columns that make it total.
    """
    return first_k(without(links, satisfied, "url"), order, k, small=small)


def all_links(pages: DataFrame, satisfied: DataFrame, profile: SiteProfile = SHOP) -> DataFrame:
    """Links of all listing pages that are not satisfied."""
    # A capture may have landed twice: one of equal ones is taken by what it lists.
    listed = one_per_key(read_listing_pages(pages, profile), ["page_no"], [F.xxhash64("links")])
    return checkpointed(without(links_of(listed), satisfied, "url"))


def unsatisfied_links(
    pages: DataFrame, satisfied: DataFrame, k: int, profile: SiteProfile = SHOP, first_slice: int = 1_000
) -> DataFrame:
    """Links of the first listing pages that hold ``k`` unsatisfied URLs.

    Pages are read in growing slices of page numbers until enough is found, so a
    small target does not parse a long listing. Each slice is one distributed pass
    and is kept; the slices grow fourfold, so there are few of them.
    """
    ends = pages.agg(F.min("page_no").alias("first"), F.max("page_no").alias("last")).first()
    found, n, start, width = None, 0, ends["first"] or 0, max(k, first_slice)
    while True:
        part = pages.where((F.col("page_no") >= start) & (F.col("page_no") < start + width))
        links = all_links(part, satisfied, profile)
        found = links if found is None else found.unionByName(links)
        n, start, width = n + links.count(), start + width, width * 4
        if n >= k or ends["last"] is None or start > ends["last"]:
            return found


def pages_needed(page_counts: DataFrame, k: int | Column, by: Sequence[str] = ()) -> DataFrame:
    """Pages to read until ``k`` new entries are found.

    ``page_counts`` is ``(*by, page_no, n_new)``. The first page is always read.
    """
    running = total_before(page_counts, "n_new", "page_no", by)
    return running.where(F.col("before").isNull() | (F.col("before") < k)).drop("before")


def most_reviewed(books: DataFrame, k: int, small: int = SMALL_PREFIX) -> DataFrame:
    """The ``k`` most reviewed books, ties by isbn."""
    return first_k(books, [F.desc("review_count"), "isbn"], k, small=small)
