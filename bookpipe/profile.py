"""Site profiles: where a page keeps what we want.

A profile is data. Supporting another site means writing another ``SiteProfile``;
single fields can be replaced by any ``Column -> Column`` through ``overrides``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column


@dataclass(frozen=True)
class Pick:
    """One value of an element: its text, or an attribute; the ``nth`` match."""

    selector: str
    attr: str | None = None
    nth: int = 0


@dataclass(frozen=True)
class Every:
    """The values of all matching elements, in page order."""

    selector: str
    attr: str | None = None


@dataclass(frozen=True)
class Group:
    """One struct per matching element; its fields are looked up inside it."""

    selector: str
    fields: Mapping[str, Pick]


Blocks = Mapping[str, "Pick | Every | Group"]


@dataclass(frozen=True)
class SiteProfile:
    name: str
    listing: Blocks
    book: Blocks
    reviews: Blocks
    overrides: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)


# The selectors of the shop pages the records are read from.
# ``/`` is a child, ``//`` a descendant, ``.`` the enclosing group.
SHOP = SiteProfile(
    name="shop",
    listing={
        "links": Every(
            '//div[@class="s-main-slot s-result-list s-search-results sg-row"]'
            '/div[@data-asin]//a[@class="a-link-normal s-no-outline"]',
            attr="href",
        ),
        "strip": Every('//span[@class="s-pagination-strip"]/*', attr="aria-disabled"),
    },
    book={
        "title": Pick('//span[@id="productTitle"]'),
        "authors": Every(
            '//div[@id="authorFollow_feature_div"]'
            '/div[@class="a-row a-spacing-top-small"]'
            '/div[@class="a-column a-span4 authorNameColumn"]/a'
        ),
        "description": Every('//div[@data-a-expander-name="book_description_expander"]/div/span'),
        "formats": Pick('//div[@id="tmmSwatches"]'),
        "image": Pick('//div[@id="main-image-container"]//img[@id="imgBlkFront"]', attr="src"),
        "bullets": Group(
            '//div[@id="detailBullets_feature_div"]/ul/li',
            {"label": Pick("./span/span"), "value": Pick("./span/span", nth=1)},
        ),
        "products": Group(
            '//div[@id="detailBulletsWrapper_feature_div"]/ul',
            {
                "rank": Pick("./li/span"),
                "rating": Pick(
                    './/span[@class="reviewCountTextLinkedHistogram noUnderline"]', attr="title"
                ),
                "count": Pick('.//span[@id="acrCustomerReviewText"]'),
            },
        ),
    },
    reviews={
        "reviews": Group(
            '//div[@id="cm_cr-review_list"]/div[@data-hook="review"]',
            {
                "user": Pick('.//div[@class="a-profile-content"]/span[@class="a-profile-name"]'),
                "text": Pick('.//span[@data-hook="review-body"]/span'),
                "stars": Pick('./div/div/div/a[@class="a-link-normal"]', attr="title"),
            },
        ),
        "pager": Every('//div[@id="cm_cr-pagination_bar"]/ul/li', attr="class"),
    },
)

# Plain article pages with a navigation list, as in the ``pages`` test table.
ARTICLES = SiteProfile(
    name="articles",
    listing={"links": Every("//nav/ul/li/a", attr="href"), "strip": Every("//nav/ul/li", attr="class")},
    book={
        "title": Pick("//title"),
        "authors": Every("//nav/ul/li/a"),
        "footer": Pick("//footer"),
    },
    reviews={"reviews": Group("//nav/ul/li", {"user": Pick("./a"), "text": Pick("./a", attr="href")})},
)
