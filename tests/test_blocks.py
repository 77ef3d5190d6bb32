import pytest
from pages import book_page, bullet, listing_page, review, review_page

from bookpipe.operators.blocks import extract_blocks, steps
from bookpipe.operators.listing import has_next, has_next_review_page
from bookpipe.profile import SHOP, Every, Group, Pick


def blocks(spark, html, wanted):
    df = spark.createDataFrame([(html,)], "html string")
    return df.select(extract_blocks("html", wanted).alias("b")).first().b.asDict(recursive=True)


def test_selectors_are_checked():
    assert steps('.//a[@b="c d"]/*') == [(False, "a", "b", "c d"), (True, "*", None, None)]
    with pytest.raises(ValueError):
        steps("//div[2]")


def test_book_page(spark):
    got = blocks(spark, book_page(7), SHOP.book)
    assert got["title"] == "A Book"
    assert got["bullets"][3] == {"label": "ISBN-13 :", "value": "978-7"}
    assert got["products"][0]["rank"] == "Rank: #1,234 in Books" and got["products"][0]["rating"] is None
    assert got["products"][1] == {"rank": "", "rating": "4.4 out of 5 stars", "count": "12,345 ratings"}
    assert got["image"] == "/i/7.jpg" and got["authors"] == [] and got["formats"] is None


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<span id='t'>a &amp; b</span>", "a & b"),
        ("<SPAN ID=t>a\n  b<br>c</SPAN>", "a b\nc"),
        ('<!-- <span id="t">no</span> --><span id="t">yes</span>', "yes"),
        ('<script>x = \'<span id="t">no</span>\'</script><span id="t">yes</span>', "yes"),
        ('<span id="t">a<script>b</script>c</span>', "ac"),
        ('<span data-x="1 > 0" id="t">a</span>', "a"),
        ('<div><span id="t">a</div>b', "a"),
        ('<span id="t">a', "a"),
        ('<span id="t">a<b>b</span>c', "ab"),
        ('<span id="t">a < b</span>', "a < b"),
        ('<span id="t"></span>', ""),
        ("<p>none", None),
        ('<span id="t"><div>a</div><div>b</div></span>', "a\nb"),
    ],
)
def test_text(spark, html, expected):
    assert blocks(spark, html, {"t": Pick('//span[@id="t"]')})["t"] == expected


def test_null_and_empty_pages(spark):
    for page in (None, "", "<<<", "<a"):
        assert blocks(spark, page, SHOP.reviews) == {"reviews": [], "pager": []}


def test_unclosed_items_are_siblings(spark):
    got = blocks(spark, '<ul id="l"><li>a<li>b<ul><li>c</ul><li>d</ul>', {"li": Every('//ul[@id="l"]/li')})
    assert got["li"] == ["a", "b\nc", "d"]


def test_paragraphs_close_each_other(spark):
    assert blocks(spark, "<p>a<p>b<div>c</div>", {"p": Every("//p")})["p"] == ["a", "b"]


def test_child_and_descendant_steps(spark):
    html = '<div id="d"><span><span>deep</span></span><i><span>aside</span></i></div>'
    got = blocks(
        spark,
        html,
        {
            "child": Every('//div[@id="d"]/span/span'),
            "any": Every('//div[@id="d"]//span'),
            "second": Pick('//div[@id="d"]//span', nth=1),
            "g": Group("//i", {"s": Pick("./span"), "none": Pick("./b")}),
        },
    )
    assert got["child"] == ["deep"] and got["any"] == ["deep", "deep", "aside"] and got["second"] == "deep"
    assert got["g"] == [{"s": "aside", "none": None}]


def test_groups_do_not_leak(spark):
    page = review_page([review("ann", "one"), review(None, "two"), review("cy", None, "bad")])
    got = blocks(spark, page, SHOP.reviews)["reviews"]
    assert [r["user"] for r in got] == ["ann", None, "cy"]
    assert [r["text"] for r in got] == ["one", "two", None]
    assert got[2]["stars"] == "bad"


def test_listing_and_pagers(spark):
    df = spark.createDataFrame([(listing_page([1, 2]), listing_page([3], last=True))], "a string, b string")
    first, last = (extract_blocks(c, SHOP.listing) for c in "ab")
    row = df.select(first["links"].alias("l"), has_next(first["strip"]).alias("x"), has_next(last["strip"]).alias("y")).first()
    assert row.l == ["/dp/1/ref=sr_0?x=1", "/dp/2/ref=sr_1?x=1"] and (row.x, row.y) == (True, False)
    pages = spark.createDataFrame([(review_page([], True), review_page([]), "<p>")], "a string, b string, c string")
    flags = pages.select(*(has_next_review_page(extract_blocks(c, SHOP.reviews)["pager"]) for c in "abc")).first()
    assert tuple(flags) == (True, False, False)


def test_bullets_with_missing_spans(spark):
    page = book_page(1, bullets=bullet("a", "b") + "<li><span><span>c</span></span></li><li>none</li>")
    assert blocks(spark, page, SHOP.book)["bullets"] == [
        {"label": "a", "value": "b"},
        {"label": "c", "value": None},
        {"label": None, "value": None},
    ]


def seconds_for(page):
    import time

    from bookpipe.operators.blocks import Layout, collect, steps

    layout = Layout([("title", steps('//span[@id="productTitle"]'), None, None)])
    start = time.perf_counter()
    found = collect(page, layout)
    return time.perf_counter() - start, found


def test_broken_pages_take_linear_time():
    for pattern in ("<b>" * 8_000 + "</i>" * 8_000, "<a '" * 16_000, '<a b="' * 11_000, "<a '" * 16_000 + ">"):
        assert seconds_for(pattern)[0] < 0.5


def test_quotes_inside_an_unquoted_value():
    page = "<span id=\"productTitle\" data-x=it's>X</span><p title=\"a > b\">y</p>"
    assert seconds_for(page)[1]["title"] == ["X"]
