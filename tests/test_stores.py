import json
import os

import pytest
from pyspark.sql import functions as F

from bookpipe.functions.records import book_url_of, from_json_records, to_json_records
from bookpipe.operators.counts import orphans, reviews_per_book, satisfied_urls
from bookpipe.schema import BOOK, REVIEW, conform, nullable
from bookpipe.sinks.stores import FileStore, JdbcStore, TableStore, image_manifest, saved_state
from bookpipe.sinks.upsert import last_write, read_bucketed, upsert
from bookpipe.sources.raw_tree import TreeIndex, list_store, read_raw_attributes, read_raw_reviews, store_keys
from bookpipe.sources.tables import saved_isbns, saved_users, table_or_empty

RECORD = dict(
    title="Title", isbn="isbn-101", uuid="uuid", author="author", description="des", date="date", pages=100,
    price=5.0, best_seller_rank=1, review_rating=2.5, review_count=400, image_url="image_url", book_url="book_url",
)
REVIEW_RECORD = dict(isbn="isbn-101", text="text", rating=3, user="user")


@pytest.fixture
def tree(tmp_path):
    book = tmp_path / "raw_data" / "isbn-101"
    (book / "reviews").mkdir(parents=True)
    (book / "data.json").write_text(json.dumps(RECORD))
    (book / "reviews" / "user.json").write_text(json.dumps(REVIEW_RECORD))
    (book / "reviews" / "data.json").write_text(json.dumps({**REVIEW_RECORD, "user": "data", "rating": None}))
    (book / "isbn-101.jpg").write_bytes(b"jpg")
    bare = tmp_path / "raw_data" / "isbn-102"
    bare.mkdir()
    (bare / "data.json").write_text(json.dumps({**RECORD, "isbn": "isbn-102", "book_url": "other"}))
    return str(tmp_path / "raw_data")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_read_raw_tree(spark, tree):
    books = read_raw_attributes(spark, tree)
    assert books.schema == nullable(BOOK) and {r.isbn for r in books.collect()} == {"isbn-101", "isbn-102"}
    assert books.where("isbn = 'isbn-101'").first().asDict() == RECORD
    assert {(r.user, r.rating) for r in read_raw_reviews(spark, tree).collect()} == {("user", 3), ("data", None)}
    assert read_raw_attributes(spark, tree + "/none").count() == 0
    assert read_raw_reviews(spark, tree + "/none").count() == 0


def test_list_store(spark, tree):
    files = list_store(spark, tree)
    assert files.count() == 5 and files.columns == ["path", "modificationTime", "length"]
    assert rows(store_keys(list_store(spark, tree, "*.json")).where("user is not null")) == [
        ("isbn-101", "data"),
        ("isbn-101", "user"),
    ]
    covers = store_keys(list_store(spark, tree, "*.jpg")).select("isbn")
    status = image_manifest(read_raw_attributes(spark, tree), covers)
    assert {(r.isbn, r.target_key, r.status) for r in status.collect()} == {
        ("isbn-101", "raw_data/isbn-101/isbn-101.jpg", "landed"),
        ("isbn-102", "raw_data/isbn-102/isbn-102.jpg", "missing"),
    }


def test_satisfied_with_no_reviews_wanted(spark, tree):
    books, reviews = read_raw_attributes(spark, tree), read_raw_reviews(spark, tree)
    urls = lambda mode, n: {
        r.book_url for r in satisfied_urls(reviews_per_book(reviews, mode, books), books, n).collect()
    }
    assert urls("users", 0) == {"book_url", "other"} and urls("rows", 0) == {"book_url"}
    assert urls("users", 2) == {"book_url"} and urls("rows", 3) == set()


def test_lookup_without_attributes(spark):
    counts = spark.createDataFrame([("a", 5), ("b", 5)], "isbn string, n long")
    books = spark.createDataFrame([("a", "u1"), ("a", "u2")], "isbn string, book_url string")
    assert {r.book_url for r in satisfied_urls(counts, books, 1).collect()} == {"u1", "u2"}
    assert [r.reason for r in orphans(counts, books, 1).collect()] == ["reviews without attributes: b"]
    assert orphans(counts, books, 6).count() == 0


def test_saved_users(spark, tree):
    reviews = read_raw_reviews(spark, tree)
    assert rows(saved_users(reviews, "isbn-101").select("user")) == [("data",), ("user",)]
    assert saved_users(reviews, "x' or '1'='1").count() == 0
    some = spark.createDataFrame([("isbn-101",), ("isbn-101",), ("none",)], "isbn string")
    assert saved_users(reviews, some).count() == 2


@pytest.mark.parametrize("format", ["parquet", "json"])
def test_file_store(spark, tmp_path, tree, format):
    store = FileStore(spark, str(tmp_path / "store"), format, tree=tree)
    assert store.attributes().count() == 2 and store.reviews().count() == 2
    books = spark.createDataFrame([{**RECORD, "isbn": "n"}], BOOK)
    new = spark.createDataFrame(
        [("n", "old", 1, "ann", 1), ("n", "new", 2, "ann", 2), ("n", "x", None, "bob", 3)],
        "isbn string, text string, rating int, user string, position long",
    )
    for _ in range(2):  # a repeated run replaces its own output
        store.write(books, new, "run-1")
    again = FileStore(spark, str(tmp_path / "store"), format)
    assert rows(again.reviews()) == [("n", "new", 2, "ann"), ("n", "x", None, "bob")]
    assert again.attributes().first().asDict() == {**RECORD, "isbn": "n"}
    assert again.reviews("run-1").count() == 0 and again.attributes("run-2").count() == 1
    assert rows(saved_isbns(again.attributes())) == [("n",)]


def test_table_store(spark):
    store = TableStore(spark, "t_books", "t_reviews")
    assert store.attributes().count() == 0 and store.reviews().count() == 0
    books = spark.createDataFrame([RECORD], BOOK)
    reviews = spark.createDataFrame([("isbn-101", "a", 1, "ann"), ("isbn-101", "b", None, "ann")], REVIEW)
    for _ in range(2):
        store.write(books, reviews, "run-1")
    assert store.attributes().count() == 1 and store.reviews().count() == 2
    assert table_or_empty(spark, "t_reviews", REVIEW).columns == REVIEW.names
    assert saved_state(store, None) is store and saved_state("raw", store) is store


def test_jdbc_store_needs_predicates(spark):
    with pytest.raises(ValueError):
        JdbcStore(spark, "jdbc:none", {}, [])


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "reviews")
    schema = "isbn string, text string, rating int, user string, seq int"
    first = [("a", "1", 1, "x", 1), ("a", "2", 2, "x", 2), ("b", "3", 3, "y", 3)]
    second = [("a", "4", None, "x", 1), ("c", "5", 5, "z", 2)]
    for batch in (first, second, second):
        upsert(spark, spark.createDataFrame(batch, schema), path, REVIEW, arrival=("seq",), buckets=4)
        files = sorted(os.listdir(path))
    stored = read_bucketed(spark, path, REVIEW)
    assert rows(stored.select(*REVIEW.names)) == [("a", "4", None, "x"), ("b", "3", 3, "y"), ("c", "5", 5, "z")]
    assert stored.where(F.expr("isbn_bucket <> pmod(hash(isbn), 4)")).count() == 0
    upsert(spark, spark.createDataFrame([], schema), path, REVIEW, arrival=("seq",), buckets=4)
    assert sorted(os.listdir(path)) == files


def test_last_write(spark):
    batch = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z")], "k string, at int, v string")
    assert [r.v for r in last_write(batch, ["k"], ["at"]).collect()] == ["y"]


def test_json_records(spark):
    books = spark.createDataFrame([{**RECORD, "author": None}], BOOK)
    encoded = to_json_records(books)
    assert '"author":null' in encoded.first().value
    assert from_json_records(encoded, BOOK).first() == books.first()
    assert encoded.select(book_url_of(F.col("value"))).first()[0] == "book_url"


def test_contract(spark):
    df = spark.createDataFrame([("u", "i", "3", "t", 1)], "user string, isbn string, rating string, text string, extra int")
    with pytest.raises(Exception):
        conform(df, REVIEW).collect()  # a string is not a rating
    good = df.withColumn("rating", F.col("rating").cast("smallint"))
    assert conform(good, REVIEW).schema == nullable(REVIEW)
    with pytest.raises(Exception):
        conform(df.drop("isbn"), REVIEW)
    with pytest.raises(TypeError):
        conform([RECORD], BOOK)


def test_upsert_keeps_its_bucket_count(spark, tmp_path):
    path, schema = str(tmp_path / "counted"), "isbn string, text string, rating int, user string, seq int"
    batch = spark.createDataFrame([("a", "1", 1, "x", 1)], schema)
    upsert(spark, batch, path, REVIEW, arrival=("seq",), buckets=8)
    with pytest.raises(ValueError):
        upsert(spark, batch, path, REVIEW, arrival=("seq",), buckets=7)
    with pytest.raises(ValueError):
        upsert(spark, batch, path, REVIEW, buckets=8)


def test_rejects_and_covers_are_stored(spark, tmp_path):
    store = FileStore(spark, str(tmp_path / "kept"))
    reviews = spark.createDataFrame([], REVIEW)
    store.write(spark.createDataFrame([RECORD], BOOK), reviews.withColumn("position", F.lit(1)), "run-1")
    quarantine = spark.createDataFrame([(1, "u", "title", "none")], "page_id bigint, url string, field string, reason string")
    for _ in range(2):
        store.reject(quarantine, "run-1")
    assert rows(store.quarantine()) == [(1, "u", "title", "none")] and store.quarantine("run-1").count() == 0
    assert [r.isbn for r in store.images().collect()] == [RECORD["isbn"]]


def test_tree_is_read_once(spark, tmp_path, tree):
    """A second sync opens new and changed files only; what holds no record goes to quarantine."""
    root = tmp_path / "raw_data"
    for i, path in enumerate(sorted(root.rglob("*.json"))):
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    index = TreeIndex(spark, tree, str(tmp_path / "index"))
    assert index.attributes().count() == index.reviews().count() == 0
    assert index.sync() == 4 and index.sync() == 0
    assert rows(index.attributes().select("isbn")) == [("isbn-101",), ("isbn-102",)]
    assert rows(index.reviews()) == rows(read_raw_reviews(spark, tree))

    opened = []
    read = TreeIndex._read

    def watched(self, schema, since):
        df = read(self, schema, since)
        opened.append({os.path.basename(os.path.dirname(f)) + "/" + os.path.basename(f) for f in df.inputFiles()})
        return df

    TreeIndex._read = watched
    try:
        (root / "isbn-102" / "data.json").write_text(json.dumps({**RECORD, "isbn": "isbn-102", "title": "Changed"}))
        (root / "isbn-103").mkdir()
        (root / "isbn-103" / "data.json").write_text('{"title": "cut o')
        (root / "isbn-101" / "reviews" / "new.json").write_text(json.dumps({**REVIEW_RECORD, "user": "new"}))
        assert index.sync() == 3 and index.sync() == 0
    finally:
        TreeIndex._read = read
    assert opened == [{"isbn-102/data.json", "isbn-103/data.json", "reviews/new.json"}] * 2
    assert rows(index.attributes().select("isbn", "title")) == [("isbn-101", "Title"), ("isbn-102", "Changed")]
    assert {r.user for r in index.reviews().collect()} == {"user", "data", "new"}
    bad = index.unreadable().collect()
    assert [(r.field, r.url.endswith("isbn-103/data.json")) for r in bad] == [("record", True)] and "cut o" in bad[0].reason
    # A sync that did not finish counts for nothing and is done again.
    (root / "isbn-104").mkdir()
    (root / "isbn-104" / "data.json").write_text(json.dumps({**RECORD, "isbn": "isbn-104"}))
    spark.createDataFrame([("x", "x")], "isbn string, path string").write.parquet(str(tmp_path / "index" / "attributes" / "sync=2"))
    assert index.attributes().count() == 2 and index.sync() == 1 and index.attributes().count() == 3
