from pyspark.sql import functions as F

from bookpipe.operators.books import extract_books
from bookpipe.operators.reviews import extract_reviews
from bookpipe.operators.validate import banned
from bookpipe.profile import SHOP, Group, Pick, SiteProfile

OTHER = SiteProfile(
    name="other",
    listing=SHOP.listing,
    book={
        **SHOP.book,
        "title": Pick("//h1"),
        "bullets": Group('//table[@id="facts"]/tr', {"label": Pick("./th"), "value": Pick("./td")}),
    },
    reviews={"reviews": Group('//li[@class="r"]', {"user": Pick("./b"), "text": Pick("./i"), "stars": Pick("./em")})},
    overrides={"price": lambda b: F.lit(9.5), "author": lambda b: F.upper(b["title"])},
)


def test_another_site_is_another_profile(spark):
    html = (
        "<h1>T</h1><table id=facts><tr><th>ISBN-13 :<td>1<tr><th>Language<td>English</table>"
        '<div id="detailBulletsWrapper_feature_div"><ul></ul></div>'
    )
    good, bad = extract_books(spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string"), profile=OTHER)
    row = good.first()
    assert (row.title, row.isbn, row.price, row.author) == ("T", "ISBN-13-1", 9.5, "T") and bad.count() == 0


def test_another_sites_reviews(spark):
    html = '<ul><li class="r"><b>ann</b><i>good</i><em>3.0 out of 5 stars</em><li class="r"><b>bob</b></ul>'
    df = spark.createDataFrame([("i", 1, html)], "isbn string, page_no int, html string")
    assert [tuple(r) for r in extract_reviews(df, OTHER).collect()] == [("i", 1, 0, "ann", "good", 3)]


def test_banned_phrases(spark):
    titles = spark.createDataFrame([("A Midnight Tale",), ("midnight",), ("x.y",), ("a\\Eb",)], "t string")
    keep = lambda phrases: [r.t for r in titles.where(~banned(F.col("t"), phrases)).collect()]
    assert keep(["Midnight"]) == ["midnight", "x.y", "a\\Eb"]
    assert keep(None) == keep([]) == [r.t for r in titles.collect()]
    many = [f"none {i}" for i in range(50)]
    assert keep([*many, "Midnight", "x.y", "\\E"]) == ["midnight"]
    assert keep([*many, "x?y"]) == [r.t for r in titles.collect()]
