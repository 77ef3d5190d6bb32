import pytest
from pyspark.sql import functions as F

from bookpipe.functions import book_fields as B
from bookpipe.functions.paths import isbn_of_path, user_of_path
from bookpipe.functions.review_fields import star_rating
from bookpipe.functions.text import joined, soft_double, soft_int
from bookpipe.functions.urls import absolute_url, normalize_url, record_id


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def bullets(*pairs):
    rows = [F.struct(F.lit(a).alias("label"), F.lit(b).alias("value")) for a, b in pairs]
    return F.array(*rows)


def products(name, *texts):
    names = ("rank", "rating", "count")
    return F.array(
        *(F.struct(*(F.lit(t if n == name else None).cast("string").alias(n) for n in names)) for t in texts)
    )


@pytest.mark.parametrize(
    "url, expected",
    [
        ("https://x/dp/1/ref=sr_1", "https://x/dp/1/"),
        ("https://x/a?pref=2", "https://x/a?p"),
        ("https://x/ref=1/ref=2", "https://x/"),
        ("https://x/dp/1", "https://x/dp/1"),
    ],
)
def test_normalize_url(spark, url, expected):
    assert value(spark, normalize_url(F.lit(url))) == expected


@pytest.mark.parametrize(
    "href, expected",
    [
        ("/dp/1", "https://x.y/dp/1"),
        ("https://z/1", "https://z/1"),
        ("//z/1", "https://z/1"),
        ("b", "https://x.y/s/b"),
    ],
)
def test_absolute_url(spark, href, expected):
    assert value(spark, absolute_url(F.lit(href), F.lit("https://x.y/s/a?q=/1"))) == expected


def test_record_id_is_stable(spark):
    assert value(spark, record_id(F.lit("u"))) == value(spark, record_id(F.lit("u")))


def test_isbn(spark):
    assert value(spark, B.isbn(bullets(("ISBN-13 :", "978-0")))) == "ISBN-13-978-0"
    assert value(spark, B.isbn(bullets(("ISBN-13 :", "978-0"), ("x", "y"), ("ISBN-13 :", "978-1")))) == "ISBN-13-978-1"
    assert value(spark, B.isbn(bullets(("ISBN-10 :", "0")))) is None


@pytest.mark.parametrize(
    "text, date, bad",
    [
        ("V (US); 1st (May 3, 2021)", "May 3 2021", False),
        ("V, May 2021", None, True),
        ("V (May 3, 2021) ", None, True),
        ("V ()", "", False),
        ("V (a) b)", "a) b", False),
        ("", None, True),
    ],
)
def test_date(spark, text, date, bad):
    b = bullets(("Language :", "English"), ("Publisher :", text))
    assert value(spark, B.date(b)) == date
    assert value(spark, B.bad_dates(b)) is bad


def test_pub_date(spark):
    assert str(value(spark, B.pub_date(F.lit("May 3 2021")))) == "2021-05-03"
    assert value(spark, B.pub_date(F.lit("soon"))) is None


@pytest.mark.parametrize("text, pages, bad", [("304 pages", 304, False), ("1,024 pages", None, True), ("none", None, False)])
def test_pages(spark, text, pages, bad):
    b = bullets(("Paperback :", text), ("x", "y"))
    assert value(spark, B.pages(b)) == pages
    assert bool(value(spark, B.bad_pages(b))) is bad


@pytest.mark.parametrize(
    "text, price",
    [
        ("Hardcover\n$9.50\nPaperback\nfrom $7.25", 7.25),
        ("Hardcover\n$9.50\nMass Market Paperback\n$3", 3.0),
        ("Paperback\n$1,024.00", None),
        ("Hardcover\n$1.00\nPaperback", None),
        ("Paperback\nfree\nHardcover\n$2", None),
        ("Audiobook\n$5", None),
        ("Paperback\n$4.4d", None),
        (None, None),
    ],
)
def test_price(spark, text, price):
    assert value(spark, B.price(F.lit(text).cast("string"))) == price


@pytest.mark.parametrize(
    "texts, rank",
    [
        (["#1,234 in Books"], 1234),
        (["#12"], None),
        (["#7 in A", "#12"], 7),
        (["#7 in A", "#8 in B #9 in C"], 8),
        (["#x in A"], None),
        (["none", None], None),
    ],
)
def test_best_seller_rank(spark, texts, rank):
    assert value(spark, B.best_seller_rank(products("rank", *texts))) == rank


@pytest.mark.parametrize(
    "texts, rating", [(["4.4 out of 5"], 4.4), (["5 out of 5"], None), (["4.4 o", "5 out"], 4.4), (["4d out"], None)]
)
def test_review_rating(spark, texts, rating):
    assert value(spark, B.review_rating(products("rating", *texts))) == rating


def test_review_count(spark):
    assert value(spark, B.review_count(products("count", "12,345 ratings"))) == 12345
    assert value(spark, B.review_count(products("count", "7 ratings", "many"))) == 7


@pytest.mark.parametrize(
    "text, stars",
    [
        ("4.9 out of 5 stars", 4),
        ("4.0 out of 10 stars", None),
        ("4.0 out of 5 stars and more", 4),
        ("4.0 out of 5 starsx", None),
        ("x out of 5 stars", None),
        ("nan out of 5 stars", None),
        ("inf out of 5 stars", None),
        ("-0.5 out of 5 stars", 0),
        ("7 out of 5 stars", 7),
        (None, None),
    ],
)
def test_star_rating(spark, text, stars):
    assert value(spark, star_rating(F.lit(text).cast("string"))) == stars


def test_joined(spark):
    none = F.lit(None).cast("array<string>")
    assert value(spark, joined(none)) == "" and value(spark, B.authors(none)) == ""
    assert value(spark, B.authors(F.array(F.lit("a"), F.lit("b")))) == "a,b"
    assert value(spark, B.description(F.array(F.lit("a"), F.lit("b")))) == "ab"


def test_soft_numbers(spark):
    for text, number in (("12", 12), (" +5 ", 5), ("1_000", 1000), ("1.0", None), ("", None), ("9" * 20, None)):
        assert value(spark, soft_int(F.lit(text))) == number
    for text, number in (("1e3", 1000.0), (".5", 0.5), ("1f", None), ("1.", 1.0), ("", None)):
        assert value(spark, soft_double(F.lit(text))) == number


def test_paths(spark):
    for path in ("raw_data/i-1/reviews/a json b.json", "s3a://b/x/raw_data/i-1/reviews/a json b.json"):
        assert value(spark, isbn_of_path(F.lit(path))) == "i-1"
        assert value(spark, user_of_path(F.lit(path))) == "a json b"
