"""Hand-written shop pages for tests."""

SITE = "https://shop.example"


def bullet(label, value):
    return f"<li><span><span>{label}</span><span>{value}</span></span></li>"


def book_page(
    n,
    title="A Book",
    language="English",
    publisher="Press; 1st (May 3, 2021)",
    pages="304 pages",
    isbn=None,
    bullets=None,
    products=True,
    title_tag=True,
):
    if bullets is None:
        bullets = "".join(
            [
                bullet("Publisher :", publisher),
                bullet("Language :", language),
                bullet("Paperback :", pages),
                bullet("ISBN-13 :", isbn or f"978-{n}"),
            ]
        )
    name = f'<span id="productTitle">{title}</span>' if title_tag else ""
    blocks = (
        '<div id="detailBulletsWrapper_feature_div"><ul><li><span>Rank: #1,234 in Books</span></li></ul>'
        '<ul><li><span class="reviewCountTextLinkedHistogram noUnderline" title="4.4 out of 5 stars"></span>'
        '<span id="acrCustomerReviewText">12,345 ratings</span></li></ul></div>'
    )
    return (
        f'<html><body>{name}<div id="detailBullets_feature_div"><ul>{bullets}</ul></div>'
        f'{blocks if products else ""}<div id="main-image-container"><img id="imgBlkFront" src="/i/{n}.jpg"/></div></body></html>'
    )


def review(user, text="fine", stars="4.9 out of 5 stars"):
    who = f'<div class="a-profile-content"><span class="a-profile-name">{user}</span></div>' if user else ""
    what = f'<span data-hook="review-body"><span>{text}</span></span>' if text is not None else ""
    return (
        f'<div data-hook="review"><div>{who}<div><div><a class="a-link-normal" title="{stars}">x</a></div></div>{what}</div></div>'
    )


def review_page(reviews, more=False):
    last = "a-last" if more else "a-disabled a-last"
    return (
        f'<div id="cm_cr-review_list">{"".join(reviews)}</div>'
        f'<div id="cm_cr-pagination_bar"><ul><li>Previous<li class="{last}">Next</ul></div>'
    )


def listing_page(numbers, last=False):
    links = "".join(
        f'<div data-asin="B{n}"><h2><a class="a-link-normal s-no-outline" href="/dp/{n}/ref=sr_{i}?x=1">b</a></h2></div>'
        for i, n in enumerate(numbers)
    )
    end = '<span aria-disabled="true">Next</span>' if last else "<a>Next</a>"
    return (
        f'<div class="s-main-slot s-result-list s-search-results sg-row">{links}</div>'
        f'<span class="s-pagination-strip"><span>1</span>{end}</span>'
    )


def url(n):
    return f"{SITE}/dp/{n}/"


def captures(spark, listing, books, reviews):
    """Rows for Captures: listing = [numbers], books = {n: html}, reviews = {n: [[review]]}."""
    from bookpipe.schema import CAPTURE

    rows, page_id = [], 0
    for page_no, numbers in enumerate(listing, 1):
        page_id += 1
        rows.append(("listing", page_no, None, page_id, f"{SITE}/s?page={page_no}", listing_page(numbers)))
    for n, html in books.items():
        page_id += 1
        rows.append(("book", None, None, page_id, url(n) + "ref=abc", html))
    for n, pages in reviews.items():
        for page_no, page in enumerate(pages, 1):
            page_id += 1
            rows.append(("review", page_no, url(n), page_id, f"{url(n)}reviews/{page_no}", review_page(page)))
    return spark.createDataFrame(rows, CAPTURE)
