"""Shop pages and saved state derived from the ``part`` and ``lineitem`` tables.

Every page is made of numbers of one table row, so what must come out of it can
be computed from the same row in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bookpipe.operators.counts import reviews_per_book
from bookpipe.schema import CAPTURE
from bookpipe.session import PAGES_A_TASK, spread, tasks_for
from bookpipe.sources.pages import Captures

SITE = "https://shop.example"
CUTOFF = "1998-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shipped_before_cutoff() -> Column:
    return F.col("l_shipdate") < F.expr(f"timestamp_ntz'{CUTOFF}'")


def book_url(key: Column) -> Column:
    return F.concat(F.lit(f"{SITE}/dp/"), key.cast("string"), F.lit("/"))


def isbn(key: Column) -> Column:
    return F.concat(F.lit("ISBN-13-978-"), key.cast("string"))


def html(template: str, *values: Column) -> Column:
    """``template`` with each ``{}`` replaced by the next value."""
    parts = template.split("{}")
    pieces = [F.lit(parts[0])]
    for value, part in zip(values, parts[1:], strict=True):
        pieces += [F.coalesce(value.cast("string"), F.lit("")), F.lit(part)]
    return F.concat(*pieces)


BOOK_PAGE = (
    "<html><body><script>if (a < b) document.write('<span id=\"productTitle\">no</span>')</script>"
    '<div id="main-image-container"><img id="imgBlkFront" src="{}"></div>'
    '<span id="productTitle" class="big"> {} \n</span>'
    '<div id="authorFollow_feature_div"><div class="a-row a-spacing-top-small">'
    '<div class="a-column a-span4 authorNameColumn"><a href="#">{}</a></div>'
    '<div class="a-column a-span4 authorNameColumn"><a href="#">Second &amp; Co</a></div></div></div>'
    '<div data-a-expander-name="book_description_expander"><div><span>About {}.</span><span>More.</span></div></div>'
    '<div id="tmmSwatches"><ul><li><span>Hardcover</span><br><span>$99.50</span>'
    "<li><span>Paperback</span><br><span>from ${}</span></ul></div>"
    '<div id="detailBullets_feature_div"><ul>'
    "<li><span><span>Publisher : </span><span>{} (US); 1st (May {}, 2021)</span></span></li>"
    "<li><span><span>Language : </span><span>{}</span></span></li>"
    "<li><span><span>Paperback : </span><span>{} pages</span></span></li>"
    "<li><span><span>ISBN-10 : </span><span>0{}</span></span></li>"
    "<li><span><span>ISBN-13 : </span><span>978-{}</span></span></li></ul></div>"
    '<div id="detailBulletsWrapper_feature_div"><ul><li><span>Best Sellers Rank: #{} in Books</span></li></ul>'
    '<ul><li><span class="reviewCountTextLinkedHistogram noUnderline" title="{} out of 5 stars">stars</span>'
    '<span id="acrCustomerReviewText">{} ratings</span></li></ul></div></body></html>'
)


def book_pages(part: DataFrame) -> DataFrame:
    """``(page_id, url, html)``; one book page per part."""
    key = F.col("p_partkey")
    page = html(
        BOOK_PAGE,
        F.concat(F.lit(f"{SITE}/img/"), key.cast("string"), F.lit(".jpg")),
        F.col("p_name"),
        F.col("p_brand"),
        F.col("p_name"),
        F.format_string("%.2f", "p_retailprice"),
        F.col("p_brand"),
        F.lit(1) + F.col("p_size") % 28,
        F.when(F.col("p_type") == "PROMO", "French").otherwise("English"),
        # A few page counts are unreadable.
        F.when((F.col("p_type") == "ECONOMY") & (F.col("p_size") > 40), "1,024").otherwise(
            (F.col("p_size") * 10).cast("string")
        ),
        key,
        key,
        F.format_number(key + 1, 0),
        F.format_string("%.1f", F.col("p_size") / 10),
        F.format_number(key * 37, 0),
    )
    return spread(part, "p_partkey", rows=PAGES_A_TASK).select(key.alias("page_id"), book_url(key).alias("url"), page.alias("html"))


LISTING_PAGE = (
    '<div class="s-main-slot s-result-list s-search-results sg-row"><div data-asin="{}"><h2>'
    '<a class="a-link-normal s-no-outline" href="/dp/{}/ref=sr_1">Book</a></h2></div>'
    '<div><a class="a-link-normal s-no-outline" href="/ad/1">Ad</a></div></div>'
    '<span class="s-pagination-strip"><a>1</a>{}</span>'
)


def listing_pages(part: DataFrame) -> DataFrame:
    """``(page_no, page_id, url, html)``; one listing page per part."""
    key = F.col("p_partkey")
    last = F.when(F.col("p_size") < 10, '<span aria-disabled="true">Next</span>').otherwise("<a>Next</a>")
    return spread(part, "p_partkey", rows=PAGES_A_TASK).select(
        key.alias("page_no"),
        key.alias("page_id"),
        F.concat(F.lit(f"{SITE}/s?page="), key.cast("string")).alias("url"),
        html(LISTING_PAGE, key, key, last).alias("html"),
    )


REVIEW_PAGE = (
    '<div id="cm_cr-review_list"><div data-hook="review" id="r1"><div><div>'
    '<div class="a-profile-content"><span class="a-profile-name">{}</span></div>'
    '<div><a class="a-link-normal" title="{}">stars</a></div></div>'
    '<span data-hook="review-body"><span>Lot {}<br>of order {}</span></span></div></div>'
    '<div data-hook="review" id="r2"><div><span data-hook="review-body"><span>by nobody</span></span></div></div></div>'
    '<div id="cm_cr-pagination_bar"><ul><li class="a-disabled">Previous</li><li class="{}">Next</li></ul></div>'
)


def review_pages(lineitem: DataFrame) -> DataFrame:
    """``(page_no, book_url, page_id, url, html)``; one review page per line.

    Each page holds one complete review and one without a user.
    """
    line = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    place = (line * 10_000_000 + F.col("l_suppkey")) * 100 + F.col("l_quantity").cast("bigint")
    stars = F.concat(F.format_string("%.1f", F.col("l_quantity") / 10), F.lit(" out of 5 stars"))
    wrong = F.concat(F.col("l_quantity").cast("string"), F.lit(" out of 50 stars"))
    return lineitem.select(
        place.alias("page_no"),
        book_url(F.col("l_partkey")).alias("book_url"),
        place.alias("page_id"),
        F.concat(book_url(F.col("l_partkey")), F.lit("reviews/"), place.cast("string")).alias("url"),
        html(
            REVIEW_PAGE,
            F.concat(F.lit("user-"), F.col("l_suppkey").cast("string")),
            F.when(F.col("l_returnflag") == "R", wrong).otherwise(stars),
            F.col("l_linenumber"),
            F.col("l_orderkey"),
            F.when(F.col("l_linestatus") == "F", "a-last").otherwise("a-disabled a-last"),
        ).alias("html"),
    )


REVIEW_ITEM = (
    '<div data-hook="review"><div><div><div class="a-profile-content"><span class="a-profile-name">{}</span></div>'
    '<div><a class="a-link-normal" title="{}">stars</a></div></div>'
    '<span data-hook="review-body"><span>Lot {}<br>of order {}</span></span></div></div>'
)
PAGE_SIZE = 10


def full_review_pages(lineitem: DataFrame) -> DataFrame:
    """``(page_no, book_url, page_id, url, html)``: the lines of a part, ten a page, with a pager that ends.

    Lines are dealt to pages by their place among those of their part, and pages to tasks as
    lines, before their HTML is made.
    """
    place = Window.partitionBy("l_partkey").orderBy("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    user = F.concat(F.lit("user-"), F.col("l_suppkey").cast("string"))
    stars = F.concat(F.format_string("%.1f", F.col("l_quantity") / 10), F.lit(" out of 5 stars"))
    rows = lineitem.select(
        F.col("l_partkey").alias("_key"),
        (F.row_number().over(place) - 1).alias("_at"),
        F.lead(F.lit(True), 1, False).over(place).alias("_goes_on"),
        "l_suppkey",
        "l_quantity",
        "l_linenumber",
        "l_orderkey",
    )
    rows = rows.withColumn("_page", F.floor(F.col("_at") / PAGE_SIZE)).repartition(tasks_for(lineitem, PAGES_A_TASK * PAGE_SIZE), "_key", "_page")
    item = html(REVIEW_ITEM, user, stars, F.col("l_linenumber"), F.col("l_orderkey"))
    # A page is ten lines, however many its part has.
    items = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_at", item.alias("_item")))), lambda x: x["_item"]), "")
    pages = rows.groupBy("_key", "_page").agg(items.alias("_items"), F.bool_and("_goes_on").alias("_more"))
    more = F.when(F.col("_more"), "a-last").otherwise("a-disabled a-last")
    number = F.col("_page") + 1
    return pages.where("_key is not null").select(
        number.alias("page_no"),
        book_url(F.col("_key")).alias("book_url"),
        (F.col("_key") * 1_000_000 + number).alias("page_id"),
        F.concat(book_url(F.col("_key")), F.lit("reviews/"), number.cast("string")).alias("url"),
        html(
            '<div id="cm_cr-review_list">{}</div><div id="cm_cr-pagination_bar"><ul>'
            '<li class="a-disabled">Previous</li><li class="{}">Next</li></ul></div>',
            F.col("_items"),
            more,
        ).alias("html"),
    )


def paged_captures(spark: SparkSession, sf_dir: str) -> Captures:
    """Listing and book pages of all parts, review pages of ten lines each."""
    part, lines = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    return Captures(listing_pages(part), book_pages(part), full_review_pages(lines))


def captures(spark: SparkSession, sf_dir: str) -> Captures:
    """Listing and book pages of all parts, review pages of lines after the cut-off."""
    part, lines = table(spark, sf_dir, "part"), spread(table(spark, sf_dir, "lineitem"), "l_orderkey")
    fresh = lines.where(~shipped_before_cutoff())
    return Captures(listing_pages(part), book_pages(part), review_pages(fresh))


def all_captures(spark: SparkSession, sf_dir: str) -> Captures:
    """Listing and book pages of all parts, review pages of all lines."""
    part, lines = table(spark, sf_dir, "part"), spread(table(spark, sf_dir, "lineitem"), "l_orderkey")
    return Captures(listing_pages(part), book_pages(part), review_pages(lines))


def landed(pages: Captures) -> DataFrame:
    """The three kinds as one table, the way a crawler lands them."""
    none = F.lit(None)
    listing = pages.listing.withColumns({"kind": F.lit("listing"), "book_url": none.cast("string")})
    books = pages.books.withColumns({"kind": F.lit("book"), "book_url": none.cast("string"), "page_no": none.cast("bigint")})
    reviews = pages.reviews.withColumn("kind", F.lit("review"))
    return listing.unionByName(books).unionByName(reviews).select(*CAPTURE.names)


class SavedLines:
    """Saved state: the books of all parts, the reviews of lines before the cut-off."""

    ledger = None

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def attributes(self, batch: str | None = None) -> DataFrame:
        key = F.col("p_partkey")
        return table(self.spark, self.sf_dir, "part").select(
            isbn(key).alias("isbn"), F.col("p_name").alias("title"), book_url(key).alias("book_url")
        )

    def reviews(self, batch: str | None = None) -> DataFrame:
        lines = table(self.spark, self.sf_dir, "lineitem").where(shipped_before_cutoff())
        return lines.select(
            isbn(F.col("l_partkey")).alias("isbn"),
            F.concat(F.lit("user-"), F.col("l_suppkey").cast("string")).alias("user"),
        )

    def counts(self, mode: str = "rows", batch: str | None = None) -> DataFrame:
        return reviews_per_book(self.reviews(), mode, self.attributes())

    def batches(self) -> list[str]:
        return []

    def exhausted(self, batch: str | None = None) -> DataFrame | None:
        return None

    def mark(self, exhausted: DataFrame, batch: str) -> None:
        raise NotImplementedError("the test tables are read-only")

    def stage(self, attributes: DataFrame, reviews: DataFrame, batch: str) -> None:
        raise NotImplementedError("the test tables are read-only")

    def write(self, attributes: DataFrame, reviews: DataFrame, batch: str) -> None:
        raise NotImplementedError("the test tables are read-only")

    def reject(self, quarantine: DataFrame, batch: str) -> None:
        raise NotImplementedError("the test tables are read-only")
